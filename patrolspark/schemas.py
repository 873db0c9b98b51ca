"""Fixed record layouts of the violation domain."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed import RAW_CLOCK_POSITION, RAW_CODE_POSITION, RAW_DATE_POSITION

# Raw police line: only positions 4 (date), 5 (code) and 19 (clock) are read,
# but the files are wide; 21 string columns cover the layout used in tests.
RAW_FIELDS = 21
RAW = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(RAW_FIELDS)])
RAW_DATE, RAW_CODE, RAW_CLOCK = (f"_c{i}" for i in (RAW_DATE_POSITION, RAW_CODE_POSITION,
                                                    RAW_CLOCK_POSITION))

# Violation record: every field optional.
VIOLATION = T.StructType([
    T.StructField("lat", T.DoubleType(), True),
    T.StructField("lng", T.DoubleType(), True),
    T.StructField("sending_date", T.TimestampType(), True),
    T.StructField("drone_id", T.StringType(), True),
    T.StructField("violation_code", T.StringType(), True),
    T.StructField("image_id", T.StringType(), True),
])

# Standard (position) message: every field required at decode time.
STANDARD = T.StructType([
    T.StructField("lat", T.DoubleType(), False),
    T.StructField("lng", T.DoubleType(), False),
    T.StructField("sending_date", T.TimestampType(), False),
    T.StructField("drone_id", T.StringType(), False),
])

# Image message: id and text content, both required.
IMAGE = T.StructType([
    T.StructField("image_id", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
])

# Keyed message stream (the columns a Kafka source gives, minus the ones unused).
KEYED = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
])
