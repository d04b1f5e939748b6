"""Operators for preparing training text, each independent of the rest of the library's operators."""
