"""sensorgrid: Spark-native analytics for networks of sensors.

Every operator takes DataFrames and returns a DataFrame, and stays lazy unless its
docstring says otherwise.  See README.md for the module map.
"""
