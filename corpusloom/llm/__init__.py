"""Operators for preparing training text (problems 1 to 10). Nothing outside this package imports it."""
