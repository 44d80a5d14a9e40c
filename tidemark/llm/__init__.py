"""Operators of a training-data pipeline, each bound to the test tables in ``catalog``."""
