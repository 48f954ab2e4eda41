"""Relational operators, one module per theme."""
