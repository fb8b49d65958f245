"""Operators of a training-data pipeline over documents, pages and a benchmark."""
