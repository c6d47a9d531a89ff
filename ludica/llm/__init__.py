"""Operators of a training-data pipeline. Nothing else in ludica imports this package."""
