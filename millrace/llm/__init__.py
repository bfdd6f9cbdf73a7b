"""Operators for preparing training text. Nothing outside this folder depends on it."""
