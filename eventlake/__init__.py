"""eventlake: JSON event streams to typed, partitioned lake tables, on PySpark."""
