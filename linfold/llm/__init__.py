"""Operators of a training-data pipeline over document tables (see ``queries.py`` for their registration)."""
