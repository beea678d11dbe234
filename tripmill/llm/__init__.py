"""Operators that prepare training text, web pages and vectors at scale."""
