"""wxpipe: JSON observation streams to a clean star schema, on Spark.

Every operator takes DataFrames and returns DataFrames, is generic over column
names and fits ``DataFrame.transform``. See README.md for the map of modules.
"""

__version__ = "0.1.0"
