"""Operators of a text training-data pipeline; nothing else in the library imports this subpackage."""
