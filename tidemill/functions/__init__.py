"""Column expressions (all JVM-side, inside whole-stage codegen; no Python UDFs)."""

from tidemill.functions.hashing import hash_hex, hash_rank_key, hash_uniform  # noqa: F401
from tidemill.functions.exprs import (  # noqa: F401
    coerce_double, date_parts, keyword_flag, null_sentinels, nan_to_null, safe_divide, yes_flag,
)
