"""Retail sales warehouse and data-quality engine on PySpark.

Everything is a function from DataFrames to DataFrames, so operators chain with
``df.transform(f)``; only the table writers in :mod:`tallyhouse.sources.tables`
and the ordered run in :mod:`tallyhouse.plans.pipeline` start Spark jobs.
"""
