"""Operators for building training corpora; nothing else in the library imports this package.

Each module is one operator with its own interface; ``queries`` applies them to the tables.
"""
