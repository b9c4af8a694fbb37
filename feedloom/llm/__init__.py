"""Operators that prepare large text corpora, and their queries."""
