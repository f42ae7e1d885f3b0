"""Operators that prepare text for model training, one module per method."""
