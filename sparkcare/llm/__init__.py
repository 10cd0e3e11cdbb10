"""Operators of a training-data pipeline.  Nothing else in the library imports this
subpackage; ``queries.py`` holds its proof queries and their SQL twins."""
