"""tidemark: PySpark-native analytics operators.

Every operator is a plain function that takes and returns Spark DataFrames (or
Columns). Planning and execution are left to Catalyst and AQE; nothing here
collects data to the driver except a bounded handful of split points.
"""

__version__ = "0.1.0"
