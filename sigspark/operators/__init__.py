"""sigspark.operators."""
