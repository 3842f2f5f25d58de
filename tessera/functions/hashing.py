"""Deterministic hash expressions shared with the DuckDB oracle.

``md5_int`` is the integer value of the first 8 hex digits of md5(key) --
the bucket rule of the reference's shuffle partitioner.  Both engines (and
Python's hashlib) agree on it, which makes splits, shards and pseudo-random
initial factors reproducible outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the character-position string hash (position mod 5).
HASHSTR_MIXER = (2, 3, 7, 11, 13)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_int(key: Column) -> Column:
    """int(md5(key)[:8], 16) as BIGINT, in [0, 2**32)."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(key, n: int) -> Column:
    """PART-1: md5 bucket in [0, n)."""
    return md5_int(_col(key)) % F.lit(n)


def shard_of(key, n: int) -> Column:
    """PART-2: integer keys go to key mod n, other keys to their md5 bucket."""
    k = _col(key).cast("string")
    return F.coalesce(F.pmod(k.try_cast("bigint"), F.lit(n)), md5_bucket(k, n))


def hash_unit(*parts, seed: int = 1) -> Column:
    """Deterministic uniform value in [0, 1) from md5 of ``a_b_..._seed``."""
    key = F.concat_ws("_", *[_col(p).cast("string") for p in parts], F.lit(str(seed)))
    return md5_int(key) / F.lit(4294967296.0)


def hashstr(s) -> Column:
    """PART-4: sum of code point times the position weight (position mod 5)."""
    c = _col(s)
    weights = F.array(*[F.lit(w) for w in HASHSTR_MIXER])
    terms = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))),
        lambda i: F.when(i <= F.length(c),
                         F.ascii(F.substring(c, i, 1)).cast("bigint")
                         * F.element_at(weights, ((i - 1) % 5 + 1).cast("int")))
        .otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
