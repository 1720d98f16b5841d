"""Operators for preparing training text: one module per operator, ``catalog`` registers their queries."""
