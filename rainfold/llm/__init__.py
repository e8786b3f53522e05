"""Operators for preparing training data, their queries and statements."""
