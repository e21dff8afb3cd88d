"""Fixed record schemas (reference case classes) as Spark StructTypes."""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("descri", T.StringType()),
    T.StructField("timelong", T.StringType()),
    T.StructField("issue", T.StringType()),
    T.StructField("shoot", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("actors", T.StringType()),
    T.StructField("directors", T.StringType()),
])

RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

TAG = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    T.StructField("timestamp", T.LongType()),
])

# One parsed stream message.
STREAM_RATING = T.StructType([
    T.StructField("uid", T.IntegerType()),
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

RECS = T.ArrayType(RECOMMENDATION)

USER_RECS = T.StructType([T.StructField("uid", T.IntegerType()), T.StructField("recs", RECS)])
MOVIE_RECS = T.StructType([T.StructField("mid", T.IntegerType()), T.StructField("recs", RECS)])
GENRES_RECS = T.StructType([T.StructField("genres", T.StringType()), T.StructField("recs", RECS)])

# Long form of a similarity table.
SIMILARITY = T.StructType([
    T.StructField("mid", T.IntegerType()),
    T.StructField("mid2", T.IntegerType()),
    T.StructField("sim", T.DoubleType()),
])
