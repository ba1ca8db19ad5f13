"""Schemas and column sets of the data model."""

from pyspark.sql import types as T

ID_COLUMNS = ("project_id", "site_id", "rack_id", "module_id", "cell_id")
MEASURES = ("voltage", "current", "temperature", "soc", "soh", "resistance", "internal_resistance", "capacity", "power")

CELL = T.StructType([T.StructField("timestamp", T.DoubleType()), *[T.StructField(c, T.LongType()) for c in ID_COLUMNS], *[T.StructField(c, T.DoubleType()) for c in MEASURES]])

POINT = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("project_id", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("site_id", "unit_id", "device", "instance", "point_name", "dtype")],
    T.StructField("value_f", T.DoubleType()),
    T.StructField("value_i", T.LongType()),
    T.StructField("value_str", T.StringType()),
    T.StructField("sample_count", T.LongType()),
])

RECORDING = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("qos", T.IntegerType()),
    T.StructField("retained", T.StringType()), T.StructField("recv_ts", T.StringType()), T.StructField("latency", T.DoubleType()),
])

HEARTBEAT = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("interval_published", T.LongType()),
    T.StructField("total_published", T.LongType()), T.StructField("timestamp", T.DoubleType()), T.StructField("topic_mode", T.StringType()),
])
