"""Rows and small functions that several test files use."""

SF = "/root/testdata/sf0.001"

# Seconds after the start of the rows below, which lie around the ends of all spans:
# a pay 899 s and 900 s after its create, one before it, receipts 3 s before and 5 s after.
START = 1_700_000_000_000
ORDER_ROWS = [
    (11, "create", "", 0), (12, "create", "", 10), (13, "pay", "aa03", 20), (14, "create", "", 30),
    (15, "pay", "aa05", 40), (16, "create", "", 50), (16, "pay", "aa06", 51), (17, "create", "", 52),
    (17, "pay", "aa06", 53), (18, "create", "", 70), (18, "pay", "aa08", 70.001), (13, "create", "", 80),
    (11, "pay", "aa01", 899), (12, "pay", "aa02", 910),
]
RECEIPT_ROWS = [
    ("zz99", "card", 5), ("aa03", "card", 17), ("aa05", "cash", 36.999), ("aa06", "card", 51.5),
    ("aa06", "cash", 54), ("aa01", "card", 904), ("aa02", "cash", 915.001),
]


def lines(data):
    return "".join(",".join([*map(str, row[:-1]), str(START + round(row[-1] * 1000))]) + "\n" for row in data)


def frame(spark, rows, schema):
    """A small frame with event time from ``ts_ms``."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("ts_ms"))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
