"""Catalogue of registered queries: name -> (Spark callable, DuckDB twin SQL or None).

Each query reads the driver tables of one scale-factor folder and returns a lazy
DataFrame. The twin SQL, when present, computes the same rows in DuckDB over the
same parquet files; ``None`` means the result is checked by closed-form tests
instead (fitted models, approximations).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def half_up_sql(sql: str) -> str:
    """Spell ``round(x, d)`` (d >= 1) as ``floor(CAST(x AS DOUBLE) * 1ed + 0.5) / 1ed``,
    the rounding the Spark side uses (``functions.exprs.round_half_up``), so both
    engines round the same doubles identically. ``round(x)`` is left alone."""
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        out.append(sql[i:j])
        k, depth, comma, quote = j + 6, 1, None, False
        while depth:
            ch = sql[k]
            if quote:
                quote = ch != "'"
            elif ch == "'":
                quote = True
            elif ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        digits = sql[comma + 1:k - 1].strip() if comma else ""
        if digits.isdigit() and int(digits) >= 1:
            x = half_up_sql(sql[j + 6:comma])
            out.append(f"(floor(CAST(({x}) AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits})")
        else:
            out.append("round(" + half_up_sql(sql[j + 6:k - 1]) + ")")
        i = k


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = half_up_sql(sql.strip())
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from tidemill.plans import (  # noqa: F401
        q_clean, q_profile, q_windows, q_sampling, q_reshape, q_scalar, q_features,
        q_models, q_evaluate, q_cluster, q_flows, q_nulls, q_certificates,
    )


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
