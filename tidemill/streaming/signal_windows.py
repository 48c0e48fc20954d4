"""W7 long form on a stream: sliding event-time windows per series with MAV and RMS.

The same function serves batch and streaming DataFrames. On a stream the event
time is cast to ``timestamp`` (``withWatermark`` refuses ``timestamp_ntz``) and a
watermark bounds the state; windows are finalised in append mode once the
watermark passes their end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.exprs import round_half_up


def windowed_mav_rms(df: DataFrame, key: str, ts: str, value: str, size: str, step: str,
                     watermark: str | None = None) -> DataFrame:
    """Sliding windows per key with count, mean absolute value and root mean square.

    Batch: windows are cut on the event time as given (``timestamp_ntz`` stays
    wall-clock, independent of the session time zone). Streaming (``watermark`` set):
    ``withWatermark`` refuses ``timestamp_ntz``, so the wall clock is carried as the
    instant it would be in UTC (``from_utc_timestamp`` of the session-zone cast) and
    window starts are shifted back the same way; windows then match the batch form in
    any session time zone (apart from the hours of a daylight-saving change).
    Window starts are returned as ``timestamp_ntz`` in both cases."""
    is_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    shift = bool(watermark and is_ntz)
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone") if shift else None
    t = F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz) if shift else F.col(ts)
    src = df.select(key, t.alias("_ts"), F.col(value).cast("double").alias("_v"))
    if watermark:
        src = src.withWatermark("_ts", watermark)
    g = src.groupBy(key, F.window("_ts", size, step).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs("_v")).alias("mav"), F.sqrt(F.avg(F.col("_v") * F.col("_v"))).alias("rms"))
    start = F.to_utc_timestamp(F.col("w.start"), tz) if shift else F.col("w.start")
    return g.select(key, start.cast("timestamp_ntz").alias("window_start"),
                    F.col("n").cast("bigint").alias("n"), round_half_up("mav", 6).alias("mav"),
                    round_half_up("rms", 6).alias("rms"))


def stream_event_windows(spark, events_dir: str, schema, size: str = "1 day", step: str = "12 hours",
                         watermark: str = "1 day", key: str = "user_id") -> DataFrame:
    """Streaming source over a folder of event parquet files."""
    stream = spark.readStream.schema(schema).parquet(events_dir)
    return windowed_mav_rms(stream, key, "ts", "value", size, step, watermark)
