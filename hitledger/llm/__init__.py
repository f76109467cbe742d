"""Operators for preparing training text, each a Spark job; see the README's table."""
