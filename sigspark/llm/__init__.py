"""Operators for text-corpus preparation. Nothing outside imports this package."""
