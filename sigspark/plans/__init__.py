"""sigspark.plans."""
