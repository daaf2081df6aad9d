"""Relational operators: each is ``DataFrame -> DataFrame`` over built-ins."""
