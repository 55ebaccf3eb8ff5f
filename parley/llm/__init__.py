"""Operators that prepare training text; nothing else in the package imports them."""
