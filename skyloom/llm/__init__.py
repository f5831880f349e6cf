"""Operators for language-model training data and for the records behind it. Nothing outside this package imports it."""
