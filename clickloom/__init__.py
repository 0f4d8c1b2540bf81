"""User-behaviour event analytics expressed as Spark DataFrame operators.

Operators take and return DataFrames. Event time travels as two columns: ``ts``
(a Spark TIMESTAMP, needed for watermarks) and ``ts_ms`` (epoch milliseconds,
used for every comparison so that boundaries are exact integers).
"""
