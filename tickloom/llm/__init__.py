"""Training-data operators over document tables: one module per operator, queries in ``queries.py``."""
