"""Generic user-supplied map -> shuffle-sort -> reduce job (TXT-22).

``map_reduce(df, mapper, reducer, n_reducers, combiner=...)``:

* ``mapper(batch: pandas.DataFrame) -> pandas.DataFrame[key, value]`` runs
  vectorized over Arrow batches (``mapInPandas``).
* ``combiner`` (same signature as the reducer, optional) collapses each map
  batch before the shuffle -- for associative reducers this bounds what a hot
  key sends to its reducer by the number of map batches.
* pairs without a key or a value are dropped (FLT-6).
* keys go to reducer ``shard_of(key, n)`` (integer keys mod n, others by md5
  bucket -- the reference's partitioner) and are sorted within each reducer.
* ``reducer(key, values: iterator) -> iterable of output tuples`` sees each
  key's values as a stream over the sorted partition, so no key's values are
  held in memory at once.

``piped(lines, mapper, reducer, n_reducers)`` is the same job with external
programs that read lines on stdin and write lines on stdout.

Built-in DataFrame operators are faster for anything they can express (word
count is ``explode`` + ``groupBy``); this is the escape hatch for arbitrary
user code, as the reference's stdin/stdout jobs were.
"""

from __future__ import annotations

import itertools
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import shard_of


def _apply_reducer(pdf: pd.DataFrame, fn, out_cols) -> pd.DataFrame:
    rows = []
    for key, grp in itertools.groupby(zip(pdf["key"], pdf["value"]), key=lambda kv: kv[0]):
        rows.extend(fn(key, (v for _, v in grp)))
    return pd.DataFrame(rows, columns=out_cols)


def map_reduce(df: DataFrame, mapper, reducer, n_reducers: int, out_schema: str,
               kv_schema: str = "key string, value long", combiner=None) -> DataFrame:
    out_cols = [f.split()[0] for f in out_schema.split(",")]
    kv_cols = [f.split()[0] for f in kv_schema.split(",")]

    def map_side(it):
        for batch in it:
            kv = mapper(batch)
            if combiner is not None and len(kv):
                kv = _apply_reducer(kv.sort_values("key", kind="stable"), combiner, kv_cols)
            yield kv[kv_cols]

    mapped = df.mapInPandas(map_side, kv_schema).dropna(subset=kv_cols)
    shuffled = (mapped.repartitionById(n_reducers, shard_of("key", n_reducers).cast("int"))
                .sortWithinPartitions("key"))

    def reduce_side(it):
        rows = ((k, v) for b in it for k, v in zip(b["key"], b["value"]))
        out, size = [], 0
        for key, grp in itertools.groupby(rows, key=lambda kv: kv[0]):
            res = list(reducer(key, (v for _, v in grp)))
            out.extend(res)
            size += len(res)
            if size >= 10000:
                yield pd.DataFrame(out, columns=out_cols)
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=out_cols)

    return shuffled.mapInPandas(reduce_side, out_schema)


# ------------------------------------------------------- external programs ----

def through_program(lines: DataFrame, command: str) -> DataFrame:
    """Output lines of ``command``, started once for each partition, as column ``line``.

    Each row's only column is a line on its stdin; a null row gives none, and a row with
    line breaks gives several.  Lines of its output end at LF, CR or CRLF.  A program that
    ends with an error fails its task.  ``command`` is for a shell, on every executor;
    files sent with ``SparkContext.addFile`` are on its path.
    """
    spark, (column,) = lines.sparkSession, lines.columns
    view = f"_piped_{uuid.uuid4().hex}"
    lines.where(F.col(f"`{column}`").isNotNull()).createOrReplaceTempView(view)
    quoted = command.replace("\\", "\\\\").replace("'", "\\'")
    # a field separator that no text line holds keeps a line in one column
    whole = r"ROW FORMAT DELIMITED FIELDS TERMINATED BY '\u0001' LINES TERMINATED BY '\n'"
    try:
        return spark.sql(f"SELECT TRANSFORM(`{column}`) {whole} USING '{quoted}' AS (line string) {whole} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def key_values(lines: DataFrame) -> DataFrame:
    """FLT-6: (key, value) of the lines that hold exactly one tab; others are dropped."""
    return (lines.select(F.split("line", "\t", -1).alias("kv")).where("size(kv) = 2")
            .select(F.col("kv")[0].alias("key"), F.col("kv")[1].alias("value")))


def piped(lines: DataFrame, mapper: str, reducer: str, n_reducers: int, combiner: str | None = None) -> DataFrame:
    """TXT-22: a mapper and a reducer program over lines; the reducers' output as column ``line``.

    The mapper writes ``key<TAB>value`` lines; lines of another form are dropped.  Pairs go to
    reducer ``shard_of(key, n_reducers)``, which reads them sorted by key.  ``combiner``
    reads the mapper's lines where they are written, unsorted and with those of another
    form, and writes pairs in their place: for reducers that may be applied in parts.
    """
    if combiner is not None:
        mapper = f"set -o pipefail\n{{ {mapper}\n}} | {{ {combiner}\n}}"
    pairs = key_values(through_program(lines, mapper))
    dealt = (pairs.repartitionById(n_reducers, shard_of("key", n_reducers).cast("int"))
             .sortWithinPartitions("key"))
    return through_program(dealt.select(F.concat_ws("\t", "key", "value").alias("line")), reducer)


# ---------------------------------------------------------- word count job ----

def word_mapper(batch: pd.DataFrame) -> pd.DataFrame:
    """Lower-cased \\w+ words of the ``value`` text column, counted per batch."""
    words = batch["value"].fillna("").str.lower().str.findall(r"\w+").explode().dropna()
    counts = words.value_counts()
    return pd.DataFrame({"key": counts.index.astype(str), "value": counts.values.astype("int64")})


def sum_reducer(key, values):
    yield (key, int(sum(values)))


def word_count(lines: DataFrame, n_reducers: int | None = None) -> DataFrame:
    """Word counts by ``n_reducers`` reducers (as many as shuffle partitions by default)."""
    n_reducers = n_reducers or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_reduce(lines.select("value"), word_mapper, sum_reducer, n_reducers,
                      "key string, value long", combiner=sum_reducer)


def word_count_builtin(lines: DataFrame) -> DataFrame:
    """The same job as a plain DataFrame plan (partial aggregation included)."""
    from tessera.functions.text import tokenize
    return (lines.select(F.explode(tokenize(F.lower("value"))).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("value")))
