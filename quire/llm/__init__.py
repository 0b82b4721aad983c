"""Operators that prepare texts for language-model training. Nothing outside this package imports it."""
