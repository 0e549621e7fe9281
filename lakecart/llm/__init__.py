"""Operators of a training-data pipeline: ten documented methods over documents, pages and conversations."""
