"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemill.session import ensure_checkpoint_dir

#: ASCII white space, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, below the shared checkpoint folder.

    The tables hold what later steps read again; the folder can be removed once a result
    is written (``release``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemill-llm/{spark.sparkContext.applicationId}"


#: Has Spark delete a query's shuffle files when the query ends, not when the driver next collects garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends
    at files that every executor sees, so a lost executor costs no recomputation. The shuffle files of the write are
    deleted at its end: nothing reads them again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    _stored[id(out)] = (weakref.ref(out), path)
    return out


#: Paths of the tables that ``materialize`` returned and that are still in use.
_stored: dict[int, tuple[weakref.ref, str]] = {}


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once everything that reads them is itself stored."""
    for df in tables:
        ref, path = _stored.pop(id(df), (None, ""))
        if ref is not None and ref() is df:
            at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (call only after results are written)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path, True)


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Number the rows of a stored table by file (in the order of the paths) and place in the file, so every read of
    the table gives a row the same number, however files are cut into tasks. Only the file names, which the driver lists to
    read them, are gathered. Local rows and computed ones (a union, say) have no place in a file: they are numbered by
    partition, so write a computed table first (``materialize``) where it is to be read twice."""
    try:
        at = df.metadataColumn("_metadata")
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    paths = sorted(r[0] for r in df.select(at["file_path"]).distinct().collect())
    files = df.sparkSession.createDataFrame(pa.table({"_path_of_file": pa.array(paths, pa.string()), "_no_of_file": pa.array(range(len(paths)), pa.int64())}))
    placed = df.select(*kept, at["file_path"].alias("_path_of_file"), at["row_index"].alias("_row_of_file"))
    return placed.join(F.broadcast(files), "_path_of_file").select(*kept, (F.shiftleft("_no_of_file", 40) + F.col("_row_of_file")).alias(name))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def squeeze_space(text: Column) -> Column:
    """Every run of ASCII white space becomes one space."""
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (null counts as empty)."""
    words = F.trim(squeeze_space(F.coalesce(text, F.lit(""))))
    return F.when(words == "", F.lit(0)).otherwise(F.size(F.split(words, " "))).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Characters that a Python worker handles at a time.
BATCH_CHARS = 2_000_000


def map_texts(df: DataFrame, keep: dict[str, Column], text: Column, new: str,
              work: Callable[[], Callable[..., tuple[list | None, list[list]]]], chars: int = BATCH_CHARS, beside: Column | None = None) -> DataFrame:
    """Run Python over texts in Arrow batches; the columns ``keep`` pass through untouched.

    ``work()`` is called once per task and gives a function of a list of texts that returns
    ``(rows, columns)``: the values of the columns ``new`` (a DDL string), and for each output row
    the index of its text (``None``: one row per text). Runs of texts hold about ``chars``
    characters; a longer text is a run of its own. The values of ``beside``, where given, are the function's second argument."""
    names = [f"c{i}" for i in range(len(keep))]
    paired = beside is not None
    plain = df.select(*[c.alias(n) for c, n in zip(keep.values(), names)], F.coalesce(text.cast("string"), F.lit("")).alias("t"), *([beside.alias("x")] if paired else []))
    added = StructType.fromDDL(new)
    types = [f.type for f in to_arrow_schema(added)]
    out = StructType([f for f in plain.schema if f.name not in ("t", "x")] + [type(f)(f"n{i}", f.dataType, True) for i, f in enumerate(added)])
    out_names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = work()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("t")).to_pylist()
            kept = pa.Table.from_batches([batch]).select(names)
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= chars:
                    size += len(texts[hi])
                    hi += 1
                rows, columns = fn(texts[lo:hi], *([batch.column(batch.schema.get_field_index("x")).slice(lo, hi - lo).to_pylist()] if paired else []))
                part = kept.slice(lo, hi - lo)
                if rows is not None:
                    part = part.take(pa.array(rows, pa.int64()))
                arrays = [c.combine_chunks() for c in part.columns] + [pa.array(c, t) for c, t in zip(columns, types)]
                yield from pa.table(arrays, names=out_names).combine_chunks().to_batches()
                lo = hi

    return plain.mapInArrow(run, out).toDF(*keep, *added.names)
