"""Operators for preparing training data; queries over the test tables in ``queries``."""
