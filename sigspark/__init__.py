"""sigspark: Spark-native signal, event and frame analytics."""

__version__ = "0.1.0"
