"""Operators for preparing training text: one module for each, and `registry` for their queries."""
