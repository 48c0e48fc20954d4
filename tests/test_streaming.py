"""W7 long form on a stream equals the batch result for every finalised window."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemill.sources.tables import read_table
from tidemill.streaming.signal_windows import stream_event_windows, windowed_mav_rms


import pytest


@pytest.mark.parametrize("tz", ["UTC", "America/Los_Angeles"])
def test_stream_equals_batch(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        _stream_equals_batch(spark, tz.replace("/", "_"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _stream_equals_batch(spark, tag):
    ev = read_table(spark, SF_SMALL, "events")
    src = tempfile.mkdtemp(prefix="tidemill-stream-")
    ev.repartition(4).write.mode("overwrite").parquet(os.path.join(src, "events"))
    stream = stream_event_windows(spark, os.path.join(src, "events"), ev.schema, watermark="0 seconds")
    ckpt = tempfile.mkdtemp(prefix="tidemill-ckpt-")
    q = (stream.writeStream.format("memory").queryName(f"ev_windows_{tag}").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql(f"SELECT * FROM ev_windows_{tag}")
    batch = windowed_mav_rms(ev, "user_id", "ts", "value", "1 day", "12 hours")
    # append mode emits windows closed by the watermark: all but the ones still open at the end
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(max_ts))
    assert got.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))
