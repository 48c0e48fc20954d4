"""Sources and sinks (S1-S7) on files written by the test into a fresh scratch folder."""

import json
import os
import struct
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemill.sources import files as S
from tidemill.sources import idx


def _tmp():
    return tempfile.mkdtemp(prefix="tidemill-test-")


def test_csv_with_header_and_na_tokens(spark):
    d = _tmp()
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("id,price,name\n1,10.5,a\n2,NA,b\n3,,NA\n4,28_,c\n")
    df = S.read_csv(spark, os.path.join(d, "t.csv"))
    rows = {r["id"]: r for r in df.collect()}
    assert rows["2"]["price"] is None and rows["3"]["name"] is None and rows["4"]["price"] == "28_"
    typed = df.select("id", F.col("price").try_cast("double").alias("price"))
    assert {r["id"]: r["price"] for r in typed.collect()} == {"1": 10.5, "2": None, "3": None, "4": None}


def test_signal_files_label_from_file_name(spark):
    d = _tmp()
    for lab in (0, 3):
        with open(os.path.join(d, f"{lab}.csv"), "w") as f:
            f.write("1,2,3,4\n5,6,7,x\n")
    df = S.read_labelled_signals(spark, os.path.join(d, "*.csv"), 4, label_from="file")
    got = sorted((r["label"], r["signal"]) for r in df.collect())
    assert got == [(0, [1.0, 2.0, 3.0, 4.0]), (3, [1.0, 2.0, 3.0, 4.0])]
    df2 = S.read_labelled_signals(spark, os.path.join(d, "*.csv"), 3, label_from="last_column")
    assert sorted(r["label"] for r in df2.collect()) == [4, 4]


def test_idx_images_and_labels(spark):
    d = _tmp()
    n, rows, cols = 3, 2, 2
    pix = bytes(range(n * rows * cols))
    with open(os.path.join(d, "img.idx"), "wb") as f:
        f.write(struct.pack(">IIII", 2051, n, rows, cols) + pix)
    with open(os.path.join(d, "lab.idx"), "wb") as f:
        f.write(struct.pack(">II", 2049, n) + bytes([7, 1, 9]))
    imgs = S.read_idx_images(spark, os.path.join(d, "img.idx")).orderBy("row_id").collect()
    assert [r["pixels"] for r in imgs] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]
    labs = S.read_idx_labels(spark, os.path.join(d, "lab.idx")).orderBy("row_id").collect()
    assert [r["label"] for r in labs] == [7, 1, 9]


def test_csv_and_json_sinks_round_trip(spark):
    d = _tmp()
    df = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 2)], "cls string, precision double, support int")
    S.write_csv(df, os.path.join(d, "out_csv"))
    back = spark.read.option("header", True).csv(os.path.join(d, "out_csv"))
    assert sorted(r["cls"] for r in back.collect()) == ["a", "b"]
    js = S.report_to_json(df, "cls").collect()
    objs = [json.loads(r["json"]) for r in js]
    assert {"a": {"precision": 0.5, "support": 1}} in objs


def _images(spark, n, parts=3):
    rows = spark.range(n, numPartitions=parts).withColumn("px", F.array(*[(F.col("id") * k) % 256 for k in range(1, 7)]))
    return rows.select("id", idx.to_bytes("px").alias("b"))


def test_idx_is_written_per_task_and_read_by_byte_ranges(spark):
    d = _tmp()
    idx.write_idx(_images(spark, 50_000), "b", f"{d}/t", [2, 3])
    assert len(os.listdir(f"{d}/t")) == 3
    back = idx.read_idx(spark, f"{d}/t", range_bytes=20_000)
    assert back.rdd.getNumPartitions() > 3  # more than one a file
    got = {tuple(r["px"]): r["n"] for r in back.groupBy(idx.byte_array("items").alias("px")).agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {}
    for i in range(50_000):
        k = tuple(i * j % 256 for j in range(1, 7))
        want[k] = want.get(k, 0) + 1
    assert got == want
    assert back.select("dims").distinct().first()["dims"] == [2, 3]
    assert back.groupBy("file").agg(F.max("row_id").alias("m"), F.count(F.lit(1)).alias("n")).where("m <> n - 1").count() == 0


def test_idx_overwrite_append_and_failed_jobs(spark):
    d = f"{_tmp()}/t"
    idx.write_idx(_images(spark, 30), "b", d, [6])
    idx.write_idx(_images(spark, 10), "b", d, [6], mode="append")
    assert idx.read_idx(spark, d).count() == 40
    before = sorted(os.listdir(d))
    with pytest.raises(Exception, match="bytes, 7 are wanted"):
        idx.write_idx(_images(spark, 10), "b", d, [7])
    with pytest.raises(Exception, match="no bytes"):
        idx.write_idx(_images(spark, 10).withColumn("b", F.when(F.col("id") < 9, F.col("b"))), "b", d, [6])
    assert sorted(os.listdir(d)) == before  # nothing half-written, nothing lost
    idx.write_idx(_images(spark, 5, 1), "b", d, [6])
    assert idx.read_idx(spark, d).count() == 5
    idx.write_idx(_images(spark, 0, 1), "b", d, [6])
    assert idx.read_idx(spark, d).count() == 0


@pytest.mark.parametrize("raw", [b"", b"\x00\x00\x08", b"\x00\x01\x08\x01\x00\x00\x00\x00", b"\x00\x00\x0d\x01\x00\x00\x00\x00", b"\x00\x00\x08\x01\x00\x00\x00\x02\x01"])
def test_damaged_idx_files_raise(spark, raw):
    d = _tmp()
    with open(f"{d}/x.idx", "wb") as f:
        f.write(raw)
    with pytest.raises(Exception, match="x.idx"):
        idx.read_idx(spark, f"{d}/x.idx").count()
