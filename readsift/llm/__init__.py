"""Operators of a training-data pipeline, their registered queries and their SQL twins."""
