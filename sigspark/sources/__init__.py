"""sigspark.sources."""
