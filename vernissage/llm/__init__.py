"""Operators for language-model training data. Nothing in the core imports this."""
