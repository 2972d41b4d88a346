"""Land-model forcing preparation as Spark DataFrame operators.

Every operator takes DataFrames plus column names and returns a DataFrame, so it
runs on any table of the right shape.  See README.md for the module map.
"""
