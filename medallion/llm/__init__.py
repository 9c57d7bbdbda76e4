"""Operators for building training data from text, each one DataFrame in, one out."""
