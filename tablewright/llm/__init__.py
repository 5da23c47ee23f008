"""Operators for large-scale training data (text), and their queries."""
