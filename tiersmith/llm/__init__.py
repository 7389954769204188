"""Operators of a training-data pipeline: thirteen document, page, vector and corpus operators, one module each."""
