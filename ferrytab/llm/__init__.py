"""Operators for training-data pipelines over text, vectors and web pages."""
