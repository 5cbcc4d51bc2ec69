"""Operators for building training corpora: ten numbered operators and their queries."""
