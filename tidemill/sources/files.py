"""File sources and sinks: CSV with header (S1), headerless multi-file with a label
taken from the file name (S2), IDX image/label files (S3), named splits (S4),
feature/target selection (S5) and CSV / JSON sinks (S6, S7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources import idx

# Cells pandas' CSV reader treats as missing by default; Spark keeps them as text.
PANDAS_NA_TOKENS = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "<NA>", "n/a", "-NaN", "-nan"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             na_tokens: list[str] | None = None) -> DataFrame:
    """CSV with a header row. Columns declared in ``schema`` are read as given;
    without a schema everything is read as string (no inference pass over the data)
    and ``na_tokens`` cells become null, the way pandas reads them."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    tokens = PANDAS_NA_TOKENS if na_tokens is None else na_tokens
    if tokens:
        string_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.select(*[
            F.when(F.col(f"`{c}`").isin(tokens), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
            if c in string_cols else F.col(f"`{c}`")
            for c in df.columns
        ])
    return df


def read_labelled_signals(spark: SparkSession, glob: str, n_values: int, label_from: str = "file",
                          label_pattern: str = r"(\d+)\.csv$") -> DataFrame:
    """Headerless numeric CSV files, one recording per line.

    ``label_from='file'`` takes the label from the file path (by default the digits of
    the file stem, ``3.csv`` -> 3; ``label_pattern`` picks another part, e.g. a
    ``label=3/`` partition folder) and keeps every column as a feature;
    ``'last_column'`` uses the last column. Unparsable cells become null (coercing
    cast); rows with a null are dropped, as the reference does. A glob concatenates
    all files in one scan.
    """
    n_cols = n_values + (1 if label_from == "last_column" else 0)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n_cols)])
    raw = spark.read.schema(schema).option("header", False).csv(glob)
    vals = [F.col(f"_c{i}").try_cast("double") for i in range(n_values)]
    if label_from == "file":
        label = F.regexp_extract(F.col("_metadata.file_path"), label_pattern, 1).try_cast("int")
    elif label_from == "last_column":
        label = F.col(f"_c{n_values}").try_cast("int")
    else:
        raise ValueError("label_from must be 'file' or 'last_column'")
    out = raw.select(F.array(*vals).alias("signal"), label.alias("label"))
    return out.where(F.expr("label IS NOT NULL AND NOT exists(signal, v -> v IS NULL)"))


def read_idx_images(spark: SparkSession, path: str) -> DataFrame:
    """S3: IDX image files (rank 3) -> ``row_id, pixels``, one row per image; byte ranges of a file are read by separate
    tasks (``sources.idx``). Row numbers count within a file."""
    return idx.read_idx(spark, path).where("size(dims) = 2").select("row_id", idx.byte_array("items").alias("pixels"))


def read_idx_labels(spark: SparkSession, path: str) -> DataFrame:
    """S3: IDX label files (rank 1, one byte per label) -> ``row_id, label``."""
    return idx.read_idx(spark, path).where("size(dims) = 0").select("row_id", idx.byte_array("items")[0].alias("label"))


def union_splits(parts: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Named splits become one DataFrame with a literal ``split`` column
    (a partition column when written, so later filters prune whole splits)."""
    frames = [df.withColumn(split_col, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def split_xy(df: DataFrame, target: str, drop: list[str] | None = None,
             features_col: str = "features") -> DataFrame:
    """Keep the target and assemble every other numeric column into a vector
    (invalid values raise, as in the reference)."""
    from pyspark.ml.feature import VectorAssembler

    drop = set(drop or []) | {target}
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    feats = [f.name for f in df.schema.fields if f.name not in drop and isinstance(f.dataType, numeric)]
    va = VectorAssembler(inputCols=feats, outputCol=features_col, handleInvalid="error")
    return va.transform(df.select(*feats, target)).select(features_col, target)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header (small result tables)."""
    df.write.mode(mode).option("header", True).csv(path)


def report_to_json(df: DataFrame, key_col: str) -> DataFrame:
    """One JSON object per report row, ``{key: {metric: value, ...}}``."""
    others = [c for c in df.columns if c != key_col]
    return df.select(F.to_json(F.create_map(F.col(key_col), F.struct(*others))).alias("json"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
