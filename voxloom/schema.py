"""Schemas of the data the library works on."""

from __future__ import annotations

from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)
SEGMENT = T.StructType(
    [
        T.StructField("start", T.DoubleType()),
        T.StructField("end", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("avg_logprob", T.DoubleType()),
        T.StructField("no_speech_prob", T.DoubleType()),
    ]
)
TRANSCRIPT = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("language", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("segments", T.ArrayType(SEGMENT)),
    ]
)
VOICE = T.StructType([T.StructField("voice_id", T.StringType()), T.StructField("length_idx", T.IntegerType()), T.StructField("vec", T.ArrayType(T.FloatType()))])
METRIC = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("run", T.StringType()),
        T.StructField("epoch", T.IntegerType()),
        T.StructField("step", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
SPLITS = ("train", "validation", "test")
