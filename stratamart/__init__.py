"""Period-by-period warehouse building on Spark: load, clean, keep history, publish, analyse.

Every operator is a plain function from DataFrames or Columns to DataFrames or Columns, so
Catalyst plans the whole chain. There are no Python UDFs.
"""
