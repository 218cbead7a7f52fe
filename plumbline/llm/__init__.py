"""Operators for preparing training text at scale.

Nothing outside this package imports it. Every operator takes a DataFrame and the names of the
columns it reads; other columns are ignored, whatever their names.
"""
