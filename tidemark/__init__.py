"""Incremental ingestion and table analytics as native Spark plans.

Every operator is a function from DataFrame (or Column) to DataFrame (or
Column).  Nothing here holds data on the driver: the only values an operator
may pull back are of a size fixed beforehand (one cursor, one header row, a
fixed number of quantile cuts).
"""

__version__ = "0.1.0"
