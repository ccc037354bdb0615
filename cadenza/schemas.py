"""One explicit schema per table the operators exchange (input types are inferred
from how the columns are used: ids are bigint, track ids are strings)."""

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("recording_msid", T.StringType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

TRACKS = T.StructType([
    T.StructField("recording_msid", T.StringType(), True),
    T.StructField("recording_mbid", T.StringType(), True),
    T.StructField("artist_name", T.StringType(), True),
    T.StructField("track_name", T.StringType(), True),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_name", T.StringType(), True),
])

COUNTS = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("recording_mbid", T.StringType(), True),
    T.StructField("count", T.LongType(), False),
])

# CSV interchange of indexed ratings (header row, no inference).
RATINGS_CSV = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("recording_mbid_index", T.LongType(), True),
    T.StructField("rating", T.DoubleType(), True),
])
