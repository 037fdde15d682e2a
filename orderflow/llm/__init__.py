"""Operators of a training-data pipeline over text, pages and vectors."""
