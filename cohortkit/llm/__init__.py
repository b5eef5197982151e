"""Operators of a training-data pipeline on Spark DataFrames.

One module per operator; each has a general interface over any table of the
stated columns.  ``queries.py`` holds the thin registered queries and their
SQL.  Nothing else in the library imports this subpackage.
"""
