"""Training-data operators.

A self-contained subpackage: nothing else in the library imports it.  Every
operator takes and returns DataFrames; ``queries.py`` holds the registered
queries over the driver's tables.
"""
