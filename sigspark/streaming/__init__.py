"""sigspark.streaming."""
