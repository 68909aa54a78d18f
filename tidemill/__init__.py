"""Change-data-capture and clickstream lake with commerce, traffic and operations KPIs.

Everything is a function from DataFrames to a DataFrame (or to a started
streaming query) built from Spark's own functions, so Catalyst plans the work.
"""
