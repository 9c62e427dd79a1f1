"""sigspark.functions."""
