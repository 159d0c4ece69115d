"""Folioscope: analytics over scholarly-article metadata, written as Spark DataFrame code.

Sub-packages
    functions   column expressions (dates from identifiers, author counts, tokens, ...)
    sources     readers and writers (JSON lines, delimited text, taxonomy pages, tables)
    operators   DataFrame-in, DataFrame-out steps (joins, profiles, trends, splits, models)
    plans       whole jobs put together from the above, and the query registry
"""
