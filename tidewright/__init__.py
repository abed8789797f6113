"""Position-report processing on Spark: from raw records to delivered XML.

Every operator is a plain function over DataFrames; see README.md for the map.
"""
