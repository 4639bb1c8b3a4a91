"""Software-delivery analytics as PySpark DataFrame jobs.

Every operator takes DataFrames and column names and returns a DataFrame.
Nothing reads the wall clock: time is an explicit ``as_of``.
"""
