"""Text operators of a training-data pipeline: one module per operator, `queries.py` applies them to the tables."""
