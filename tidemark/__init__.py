"""tidemark: keep a year/month/day partitioned parquet lake in step with source tables.

Every operator is a plain function over DataFrames; only ``sinks`` and ``streaming``
write files. Nothing but the affected-partition set (bounded by the calendar) is ever
brought to the driver.
"""

__version__ = "0.1.0"
