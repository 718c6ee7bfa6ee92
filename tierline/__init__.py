"""tierline: layered (bronze, silver, gold) results pipelines on Spark.

Every operator takes and returns DataFrames and is written with built-in
Spark SQL expressions; sinks write through DataFrame writers.
"""

__version__ = "0.1.0"
