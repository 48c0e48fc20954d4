"""Deterministic pseudo-randomness from keys.

Sampling, splitting and null injection order rows by ``md5(key|seed)``. The same
expression in DuckDB (``md5(cast(key AS VARCHAR) || '|42')``) gives the same
string, so sampled rows can be checked row for row. The hash is per row, so the
order is computed where the row lives and no data moves to compute it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key_text(keys) -> Column:
    if isinstance(keys, (str, Column)):
        keys = [keys]
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.concat_ws("|", *parts) if len(parts) > 1 else parts[0]


def hash_hex(keys, seed: int = 42) -> Column:
    """``md5('<key>|<seed>')`` as 32 hex characters."""
    return F.md5(F.concat(_key_text(keys), F.lit(f"|{seed}")))


def hash_rank_key(keys, seed: int = 42) -> Column:
    """Sort key for a seeded random order (string compare of the md5 hex)."""
    return hash_hex(keys, seed)


def hash_uniform(keys, seed: int = 42) -> Column:
    """A number in [0, 1) from the first 32 bits of the md5 (equal to DuckDB's
    ``cast('0x' || substr(md5(..), 1, 8) AS BIGINT) / 4294967296``)."""
    h = F.conv(F.substring(hash_hex(keys, seed), 1, 8), 16, 10).cast("bigint")
    return h / F.lit(4294967296.0)
