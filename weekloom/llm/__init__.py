"""Operators for building language-model training data: ten jobs over documents and vectors."""
