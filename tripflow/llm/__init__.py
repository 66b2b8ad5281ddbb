"""Training-data operators (deduplication, mixing, filtering, tokenising).

Nothing else in the library imports this subpackage.  The operators take
and return DataFrames; ``queries.py`` registers one query per operator
over the given tables.
"""
