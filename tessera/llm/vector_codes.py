"""Product codes for vectors: integer k-means on each part, pruned by norm-of-sum bounds.

A vector's components become integers ``floor(256 * x)``; the integers are cut
into parts, and each part has a codebook of at most ``entries`` entries.  Every
round assigns each part to its nearest entry and replaces the entries by
floored means; the codebooks of all rounds are kept.

Method: the entries of a codebook lie in groups of neighbours.  For each part of
a vector and each group a row keeps a lower bound of the distance to the group's
entries other than the assigned one, and the round it was measured in (its
stamp).  A later round lowers the bound by the greatest distance between where
an entry of the group stood at the stamp and where it stands now, read from the
codebook history: the norm of the summed moves, never more than the sum of the
moves' norms.  Only groups whose lowered bound does not exceed the exact
distance to the assigned entry are scanned again; bounds that hold keep their
stamp.  Results are those of a full scan: distances are exact integers, equal
ones go to the lower index, and the bounds are rounded down.

Every round is one pass over a written table (integers, codes, bounds, stamps)
and a sum over it; the driver holds the codebooks only, whose size follows from
the parameters.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
components are dropped.  So are vectors of another length than the most common
one (of equally common ones the longest), which have no parts in common with the
rest, and vectors with a component too large for the squared distances to fit 64
bits (|x| over 2^19 at 64 components).  A length that the number of parts does
not divide is cut as evenly as possible.  With fewer distinct ids than
``entries`` the codebooks have as many entries as there are; a repeated id
counts once there, with its smallest vector, and a null id comes last.  Repeated
rows each get a row.  An empty table, or one without a usable vector, gives an
empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, drop_saved, saved, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Entries that share a bound.
GROUP = 8
#: Below it, float64 holds every term of a squared distance exactly.
EXACT = 1 << 22
FAR = np.iinfo(np.int64).max
#: Labels with an error sum that may be broadcast.
BROADCAST_LABELS = 100_000
SALTS = 32


@dataclass
class Codebooks:
    """Codebooks of all rounds: ``history[round][part]`` is an (entries, width) integer array."""

    dim: int
    parts: int
    history: list = field(default_factory=list)

    @property
    def edges(self) -> list[int]:
        return [self.dim * i // self.parts for i in range(self.parts + 1)]

    def cut(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:z] for a, z in zip(self.edges, self.edges[1:])]

    def sha256(self) -> str:
        """Digest of the last entries by part, entry and position."""
        return hashlib.sha256(",".join(str(v) for book in self.history[-1] for v in book.ravel().tolist()).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Vectors (in the units of the input) that the codes stand for."""
        return np.hstack([book[codes[:, p]] for p, book in enumerate(self.history[-1])]) / 256.0


def groups_of(entries: np.ndarray, size: int = GROUP) -> list[np.ndarray]:
    """Indexes of entries in groups of neighbours: halves along the widest component, down to ``size``."""
    def halve(ids: np.ndarray) -> list[np.ndarray]:
        if len(ids) <= size:
            return [np.sort(ids)]
        x = entries[ids]
        ids = ids[np.argsort(x[:, np.argmax(np.ptp(x, axis=0))], kind="stable")] if x.shape[1] else ids
        return halve(ids[:len(ids) // 2]) + halve(ids[len(ids) // 2:])
    return halve(np.arange(len(entries)))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` and ``c``."""
    if not x.shape[1]:
        return np.zeros((len(x), len(c)), np.int64)
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT and x.shape[1] <= 256:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    return sum((x[:, i, None] - c[None, :, i]) ** 2 for i in range(x.shape[1]))


def _down(x: np.ndarray) -> np.ndarray:
    """float32 below ``x`` (a distance from an exact square)."""
    return np.nextafter((x * (1 - 1e-9)).astype(np.float32), np.float32(-np.inf))


def net_moves(history: list[np.ndarray], groups: list[np.ndarray]) -> np.ndarray:
    """(round, group): greatest distance of an entry's place at that round from its place now."""
    now = history[-1].astype(np.float64)
    moved = np.array([np.sqrt(((now - old) ** 2).sum(1)) for old in history])
    return np.array([[m[g].max(initial=0.0) for g in groups] for m in moved]) * (1 + 1e-9)


def first_round(x: np.ndarray, book: np.ndarray, groups: list[np.ndarray]):
    """Full scan of one part: (code, bounds, stamps, squared distance)."""
    d2 = squared(x, book)
    code = d2.argmin(1)
    rows = np.arange(len(x))
    best = d2[rows, code]
    d2[rows, code] = FAR
    low = np.stack([_down(np.sqrt(d2[:, g].min(1).astype(np.float64))) for g in groups], axis=1)
    return code, low, np.zeros(low.shape, np.uint8), best


def next_round(x: np.ndarray, history: list[np.ndarray], groups: list[np.ndarray],
               code: np.ndarray, low: np.ndarray, stamp: np.ndarray):
    """One part against the moved entries: (code, bounds, stamps, squared distance, distances computed)."""
    now, book, rows = len(history) - 1, history[-1], np.arange(len(x))
    moves = net_moves(history, groups)
    here = ((x - book[code]) ** 2).sum(1)
    reach = np.sqrt(here.astype(np.float64)) * (1 + 1e-9)
    held = low - moves[stamp, np.arange(len(groups))[None]]
    again = held <= reach[:, None]
    d2 = np.full((len(x), len(book)), FAR, np.int64)
    for g, members in enumerate(groups):
        at = np.flatnonzero(again[:, g])
        if len(at):
            d2[at[:, None], members[None]] = squared(x[at], book[members])
    d2[rows, code] = here
    after = d2.argmin(1)
    best = d2[rows, after]
    d2[rows, after] = FAR
    low, stamp = low.copy(), stamp.copy()
    for g, members in enumerate(groups):
        at = np.flatnonzero(again[:, g])
        low[at, g] = _down(np.sqrt(d2[at[:, None], members[None]].min(1).astype(np.float64)))
        stamp[at, g] = now
        # the entry left behind belongs to this group's bound from now on
        left = np.flatnonzero(~again[:, g] & (after != code) & np.isin(code, members))
        low[left, g] = _down(np.minimum(np.maximum(held[left, g], 0), np.sqrt(here[left].astype(np.float64))))
        stamp[left, g] = now
    return after, low, stamp, best, again @ np.array([len(g) for g in groups]) + 1


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.floor(256.0 * x).astype(np.int64)


def _binary(a: np.ndarray) -> pa.Array:
    a = np.ascontiguousarray(a).reshape(len(a), -1)
    return pa.array([r.tobytes() for r in a], pa.binary())


def _array(column: pa.Array, kind, shape: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _chunks(batches, dim: int, entries: int):
    rows = max(64, (1 << 19) // max(dim, entries))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


STATE = "x binary, code binary, low binary, stamp binary, n_distances long, error long"


def _round(books: Codebooks, last: bool):
    """Task of one round; it starts from vectors in round 0, else from the state before."""
    history, parts, dim = books.history, books.parts, books.dim
    n = len(history[0][0])

    def run(batches):
        groups = [groups_of(book) for book in history[0]]
        shape = (parts, len(groups[0]))
        for batch in _chunks(batches, dim, n):
            first = len(history) == 1
            x = _integers(batch.column("x"), dim) if first else _array(batch.column("x"), np.int32, (dim,)).astype(np.int64)
            size = len(x)
            code, low, stamp = np.zeros((size, parts), np.uint8), np.zeros((size, *shape), np.float32), np.zeros((size, *shape), np.uint8)
            done, error = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if not first:
                old = [_array(batch.column(c), k, s) for c, k, s in (("code", np.uint8, (parts,)), ("low", np.float32, shape), ("stamp", np.uint8, shape))]
                done += batch.column("n_distances").to_numpy()
            for p, part in enumerate(books.cut(x)):
                if first:
                    code[:, p], low[:, p], stamp[:, p], d2 = first_round(part, history[0][p], groups[p])
                    spent = n
                else:
                    code[:, p], low[:, p], stamp[:, p], d2, spent = next_round(
                        part, [h[p] for h in history], groups[p], old[0][:, p].astype(np.int64), old[1][:, p], old[2][:, p])
                error += d2
                done += spent
            keep = [batch.column(c) for c in ("id", "label")]
            if last:
                yield pa.RecordBatch.from_arrays([*keep, _binary(code), pa.array(error), pa.array(done)], ["id", "label", "code", "error", "n_distances"])
            else:
                yield pa.RecordBatch.from_arrays([*keep, _binary(x.astype(np.int32)), _binary(code), _binary(low), _binary(stamp), pa.array(done), pa.array(error)],
                                                 ["id", "label", "x", "code", "low", "stamp", "n_distances", "error"])
    return run


def _sums(books: Codebooks):
    """Task: component sums and counts of each entry, once at the task's end."""
    dim, parts, n = books.dim, books.parts, len(books.history[0][0])
    edges = books.edges

    def run(batches):
        total, count = np.zeros((n, dim), np.int64), np.zeros((n, dim), np.int64)
        for batch in _chunks(batches, dim, n):
            x, code = _array(batch.column("x"), np.int32, (dim,)), _array(batch.column("code"), np.uint8, (parts,))
            for p in range(parts):
                used = np.bincount(code[:, p], minlength=n)
                for i in range(edges[p], edges[p + 1]):
                    total[:, i] += np.bincount(code[:, p], weights=x[:, i], minlength=n).astype(np.int64)
                    count[:, i] += used
        entry, i = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(entry), pa.array(i), pa.array(count[entry, i]), pa.array(total[entry, i])],
                                         ["entry", "i", "n", "total"])
    return run


def _moved(books: Codebooks, state: DataFrame) -> None:
    """Append the next codebooks: floored means; entries without a part stay."""
    found = (state.select("x", "code").mapInArrow(_sums(books), "entry long, i long, n long, total long")
             .groupBy("entry", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    whole = np.hstack(books.history[-1])
    for row in found.collect():  # entries x components, whatever the number of rows
        whole[row.entry, row.i] = int(row.total) // row.n
    books.history.append(books.cut(whole))


def _finite(x: Column) -> Column:
    return x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label"):
    """((id, label, x) of the rows that can be coded, length of their vectors; 0: none)."""
    group = F.lit(None).cast("int") if label is None else F.col(f"`{label}`")
    rows = vectors.select(F.col(f"`{vec_id}`").alias("id"), group.alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    rows = rows.where(_finite(F.col("x")))
    common = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = common[0].dim if common else 0
    largest = 2.0 ** ((61 - max(dim - 1, 0).bit_length()) // 2 - 8)
    return rows.where((F.size("x") == dim) & F.forall("x", lambda v: F.abs(v) <= largest)), dim


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label"):
    """``((id, label, code, error, n_distances), codebooks)``.

    ``code`` has one byte for each part, ``error`` is the squared distance to
    the coded vector in integer units, ``n_distances`` says how many entry
    distances the row took (a full scan: parts x entries x (rounds + 1)).
    Without a usable vector the codebooks have no history.
    """
    if not (1 <= entries <= 256 and parts >= 1 and 0 <= rounds <= 254):
        raise ValueError("entries must be 1 to 256, parts 1 or more, rounds 0 to 254")
    rows, dim = usable(vectors, vec_id, vector, label)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"id {kinds['id']}, label {kinds['label']}, code binary, error long, n_distances long"
    books = Codebooks(dim, parts)
    ids = rows.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries)
    first = (rows.alias("r").join(F.broadcast(ids.alias("i")), F.col("r.id").eqNullSafe(F.col("i.id")))
             .groupBy("r.id").agg(F.min("r.x").alias("x")).orderBy(F.asc_nulls_last("id")).collect())
    if not first:
        return vectors.sparkSession.createDataFrame([], out), books
    books.history.append(books.cut(np.floor(256.0 * np.array([r.x for r in first])).astype(np.int64)))
    state = rows
    for k in range(rounds):
        after = saved(state.mapInArrow(_round(books, False), f"id {kinds['id']}, label {kinds['label']}, {STATE}"), "op12-state")
        if k:
            drop_saved(state)
        state = after
        _moved(books, state)
    codes = saved(state.mapInArrow(_round(books, True), out), "op12-codes")
    if rounds:
        drop_saved(state)
    return codes, books


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``(id, vector array<double>)`` of what the codes stand for."""
    kind = codes.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = books.decode(_array(batch.column("code"), np.uint8, (books.parts,)))
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * books.dim)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["id", "vector"])
    return codes.select("id", "code").mapInArrow(run, f"id {kind}, vector array<double>")


def with_label_error(codes: DataFrame, broadcast_labels: int = BROADCAST_LABELS, salts: int = SALTS) -> DataFrame:
    """Adds ``label_error``: the error summed over equal labels, nulls together.

    The sums, one row a label, are counted and broadcast up to
    ``broadcast_labels``; beyond that a label's rows are spread over ``salts`` parts.
    """
    sums = saved(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "op12-labels")
    if sums.count() <= broadcast_labels:
        other = sums.select(F.col("label").alias("_label"), "label_error")
        return codes.join(F.broadcast(other), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    part = F.pmod(F.xxhash64("code", "error"), F.lit(salts)).cast("int")
    other = sums.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return (codes.withColumn("_part", part).join(other, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_part") == F.col("_salt")))
            .drop("_label", "_salt", "_part"))


def _sql() -> str:
    """DuckDB form: every distance of every round."""
    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (SELECT rid, p, (min(struct_pack(d := d, e := e))).e AS e, min(d) AS d FROM (
    SELECT v.rid, v.p, b.e, sum((v.x - b.x) * (v.x - b.x)) AS d FROM v JOIN b{k} b ON v.p = b.p AND v.i = b.i GROUP BY ALL) GROUP BY ALL),"""
    def moved(k: int) -> str:
        return f"""
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT a.p, a.e, v.i, CAST(floor(sum(v.x) / count(*)) AS BIGINT) AS x FROM a{k} a JOIN v ON v.rid = a.rid AND v.p = a.p GROUP BY ALL) m
    ON b.p = m.p AND b.e = m.e AND b.i = m.i),"""
    steps = "".join(assigned(k) + moved(k) for k in range(ROUNDS)) + assigned(ROUNDS)
    return f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT rid, vec_id, (i - 1) // (n // {PARTS}) AS p, (i - 1) % (n // {PARTS}) AS i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM (
    SELECT rid, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i, len(embedding) AS n FROM kept)),
b0 AS MATERIALIZED (SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, i, x FROM v
    WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY 1 LIMIT {ENTRIES})),{steps}
coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rid),
book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid), book"""


@REGISTRY("op12_vector_codes", _sql())
def op12(spark, sf_dir):
    """Code and errors of every vector, with the digest of the codebooks."""
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    code = F.lower(F.hex("code"))
    digest = F.lit(books.sha256() if books.history else None).cast("string")
    return with_label_error(codes).select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
                                          digest.alias("codebooks_sha256"))
