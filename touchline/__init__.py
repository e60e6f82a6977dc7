"""Competition analytics on Spark DataFrames.

``functions``  column expressions (keys, text, dates, arrays)
``sources``    landed payloads, table replacement, raw schemas
``operators``  DataFrame -> DataFrame operators, generic in column names
``plans``      the football warehouse put together from the operators
"""
