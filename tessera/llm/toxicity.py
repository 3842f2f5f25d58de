"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Method: a bounded sample of labelled texts (``MAX_EXAMPLES`` of each label, by
hash order, a documented parameter) gives the examples.  Terms are lower-cased
words; a term's weight is its inverse document frequency, counted over all
documents, times the z-value of its difference between the labels among the
examples, so that cosines compare what tells the labels apart.  Every term of
the examples takes part (``MIN_Z`` 0): a z-value grows with the sample, so no
fixed bound on it would suit all sizes.  The examples form a
block-max inverted index: postings by term and block of ``BLOCK`` examples,
with each block's largest weight.  Frequent terms are met by one product for a
batch of texts; blocks whose upper bound cannot reach the k-th best of it are
skipped for the other terms, which leaves the k nearest exact.  Votes are weighted by cosine and by how many labelled
rows an example of its label stands for, and shrunk to the labels' share.

The index is at most ``2 * MAX_EXAMPLES`` sparse rows whatever the corpus, and
is sent to the executors once; texts never move.

Defined cases: a null or empty text, or one without a known term, scores the
share of toxic labels; without labels every score is 0; a document with
several labels counts as toxic if one says so, null labels are ignored;
repeated rows score alike; ties for the k-th place go to the smaller example
number; doc_ids are of any type; an empty table gives an empty result; extra
columns stay in :func:`keep_clean`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field, fields
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import REGISTRY, saved, slices, table
from tessera.llm.windows import ranges

MAX_EXAMPLES = 4000
NEIGHBOURS = 15
MIN_Z = 0.0
BLOCK = 512
#: Terms that may also stand as dense rows.
DENSE = 1000
#: Texts of one product over the dense terms.
TEXTS = 512
#: Examples whose terms reach the driver at once.
FETCH = 1000
#: More than the error of a single-precision product over ``DENSE`` terms of unit vectors, twice.
SLACK = 2e-4
#: Weight of the labels' share in a vote, in units of cosine.
SHRINK = 0.1
WORD = re.compile(r"[^\W\d_]+")
#: ASCII letters in lower case, other ASCII a space, other bytes as they are.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words(text: str) -> list[str]:
    """``WORD`` of the lower-cased text, in any order; only stretches with other than ASCII letters need it."""
    if "\u03a3" in text:  # its lower case depends on what stands around it
        return WORD.findall(text.lower())
    parts = text.encode().translate(LETTERS).decode().split()
    if text.isascii():
        return parts
    odd = " ".join([w for w in parts if not w.isascii()])
    return [w for w in parts if w.isascii()] + WORD.findall(odd.lower())


def held_out(doc_id: Column, parts: int = 5, part: int = 0) -> Column:
    """crc32 of the id as text leaves ``part`` modulo ``parts`` (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


@dataclass
class Index:
    """Block-max inverted index of the examples.

    Only the postings are sent; what follows from them is made where it is used.
    """

    terms: pa.Array
    idf: np.ndarray
    counts: np.ndarray      # postings of each term
    rows: np.ndarray        # by term and example
    weights: np.ndarray
    votes: np.ndarray       # labelled rows an example stands for
    toxic: np.ndarray
    ids: list
    prior: float
    id_type: T.DataType = field(default_factory=T.LongType)

    def __post_init__(self):
        self.dense = None

    def __getstate__(self):
        return {f.name: getattr(self, f.name) for f in fields(self)} | {"dense": None}

    @cached_property
    def vocabulary(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    @cached_property
    def _cells(self) -> tuple[np.ndarray, np.ndarray]:
        blocks = max(1, -(-len(self.toxic) // BLOCK))
        cell = np.repeat(np.arange(len(self.counts)) * blocks, self.counts) + self.rows // BLOCK
        pointers = np.zeros(len(self.counts) * blocks + 1, np.int32)
        np.add.at(pointers[1:], cell, 1)
        np.cumsum(pointers, dtype=np.int32, out=pointers)
        block_max = np.zeros(len(self.counts) * blocks, np.float32)
        np.maximum.at(block_max, cell, self.weights)
        return pointers, block_max.reshape(len(self.counts), blocks)

    @property
    def pointers(self) -> np.ndarray:
        """(terms * blocks + 1) into rows, weights."""
        return self._cells[0]

    @property
    def block_max(self) -> np.ndarray:
        """Terms x blocks."""
        return self._cells[1]

    def _widen(self):
        """Frequent terms also stand as dense rows, for one product a batch of texts."""
        size, blocks = len(self.toxic), self.block_max.shape[1]
        count = np.diff(self.pointers[::blocks])
        often = np.argsort(-count, kind="stable")[:DENSE]
        often = often[count[often] * 64 >= max(1, size)]
        self.slot = np.full(len(count), -1)
        self.slot[often] = np.arange(len(often))
        dense = np.zeros((len(often), size), np.float32)
        for i, t in enumerate(often.tolist()):
            a, z = self.pointers[t * blocks], self.pointers[(t + 1) * blocks]
            dense[i, self.rows[a:z]] = self.weights[a:z]
        self.dense = dense

    def vectors(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, weights) of each text; a batch looks a word up in the vocabulary once."""
        counts = [Counter(words(t)) for t in texts]
        known = {w: self.vocabulary.get(w, -1) for w in set().union(*counts)}
        out = []
        for count in counts:
            terms = np.fromiter(map(known.__getitem__, count), np.int64, len(count))
            times = np.fromiter(count.values(), float, len(count))
            terms, times = terms[terms >= 0], times[terms >= 0]
            value = (1 + np.log(times)) * self.idf[terms]
            norm = math.sqrt(float((value * value).sum()))
            out.append((terms, value / norm if norm else value))
        return out

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.vectors([text])[0]

    def _postings(self, terms, value, blocks) -> np.ndarray:
        """Each example's sum over its postings of ``terms`` in ``blocks``."""
        all_blocks = self.block_max.shape[1]
        if len(blocks) == all_blocks:  # a term's blocks stand in a row
            start, count = self.pointers[terms * all_blocks], self.pointers[(terms + 1) * all_blocks]
            count, each = count - start, value
        else:
            cell = (terms[:, None] * all_blocks + blocks[None, :]).ravel()
            start, each = self.pointers[cell], np.repeat(value, len(blocks))
            count = self.pointers[cell + 1] - start
        at, each = ranges(start, count), np.repeat(each, count)
        return np.bincount(self.rows[at], self.weights[at] * each, minlength=len(self.toxic))

    def _best(self, terms, value, base, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``base``: the frequent terms' part of each example's cosine, in single precision."""
        slot = self.slot[terms]
        rare = slot < 0
        low, weight = terms[rare], value[rare]
        bound = weight @ self.block_max[low] + np.maximum.reduceat(base, np.arange(0, len(base), BLOCK))
        order = np.argsort(-bound, kind="stable")
        floor = np.partition(base, -k)[-k] if len(base) >= k else 0.0  # weights are not negative
        if floor > SLACK:
            order = order[bound[order] >= floor - SLACK]
        part = self._postings(low, weight, order)
        scores = base + part
        least = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        near = np.flatnonzero(scores >= least - SLACK) if least > SLACK else np.flatnonzero(scores > 0)
        # both parts are summed term by term for each example: equal examples stay equal
        dense = self.dense[slot[~rare][:, None], near[None, :]]
        cosine = np.round(part[near] + (dense * value[~rare][:, None]).sum(axis=0), 12)
        best = np.argsort(-cosine, kind="stable")[:k]
        best = best[cosine[best] > 0]
        return near[best], cosine[best]

    def nearest_of(self, texts: list[str], k: int = NEIGHBOURS):
        """For each text, the k examples with the largest positive cosine, and the cosines.

        The product over the frequent terms is in single precision; examples within its error
        (``SLACK``) of the k-th place are scored again in double precision.
        """
        if self.dense is None:
            self._widen()
        for at in range(0, len(texts), TEXTS):
            vectors = self.vectors(texts[at:at + TEXTS])
            often = np.zeros((len(vectors), len(self.dense)), np.float32)
            for i, (terms, value) in enumerate(vectors):
                slot = self.slot[terms]
                often[i, slot[slot >= 0]] = value[slot >= 0]
            for (terms, value), base in zip(vectors, often @ self.dense):
                if len(terms) and len(base):
                    yield self._best(terms, value, base, k)
                else:
                    yield np.zeros(0, np.int64), np.zeros(0)

    def nearest(self, text: str, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        return next(self.nearest_of([text], k))

    def judge_all(self, texts: list[str], k: int = NEIGHBOURS) -> list[tuple[float, list]]:
        """(score, the three nearest examples' ids) of each text."""
        scale = SHRINK * float(self.votes.mean()) if len(self.votes) else 1.0
        out = []
        for best, cosine in self.nearest_of(texts, k):
            vote = cosine * self.votes[best]
            score = (float((vote * self.toxic[best]).sum()) + scale * self.prior) / (float(vote.sum()) + scale)
            out.append((min(1.0, max(0.0, score)), [self.ids[i] for i in best[:3]]))
        return out

    def judge(self, text: str, k: int = NEIGHBOURS) -> tuple[float, list]:
        return self.judge_all([text], k)[0]


def _terms(batches):
    for batch in slices(batches, "text"):
        out = {"example": [], "term": [], "n": []}
        for example, text in zip(batch.column("example").to_pylist(), batch.column("text").to_pylist()):
            for term, n in Counter(words(text or "")).items():
                out["example"].append(example)
                out["term"].append(term)
                out["n"].append(n)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("example", pa.int64()), ("term", pa.string()), ("n", pa.int64())]))


def _frequencies(shared):
    def run(batches):
        known = {t: i for i, t in enumerate(shared.value.to_pylist())}
        total = np.zeros(len(known), np.int64)
        for batch in slices(batches, "text", 16 << 20):
            found = Counter()  # a slice looks a word up in the vocabulary once
            for text in batch.column("text").to_pylist():
                found.update(set(words(text or "")))
            at = np.fromiter((known.get(w, -1) for w in found), np.int64, len(found))
            n = np.fromiter(found.values(), np.int64, len(found))
            total[at[at >= 0]] += n[at >= 0]
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"t": t, "n": total[t]}, schema=pa.schema([("t", pa.int64()), ("n", pa.int64())]))
    return run


def document_frequencies(docs: DataFrame, terms: pa.Array | Iterable[str]) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents."""
    terms = terms if isinstance(terms, pa.Array) else pa.array(list(terms), pa.string())
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    found = docs.select("text").mapInArrow(_frequencies(shared), "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[found["t"].to_numpy()] = found["n"].to_numpy()
    shared.unpersist()
    return df, docs.count()


def _weighted_terms(terms: DataFrame, examples: np.ndarray, keys: np.ndarray, weight: np.ndarray):
    """(example, term, weight in its unit vector) of each known term of an example, by their
    numbers, and each example's weightiest term.

    Terms go by their hash, as 64-bit keys do elsewhere; ``examples`` and ``keys`` are sorted.
    The driver gets the rows of ``FETCH`` examples at once, as Arrow columns, and keeps 12 bytes of a row.
    """
    heavy = np.full(len(examples), len(keys))
    parts = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))]
    for at in range(0, len(examples), FETCH):
        some = examples[at:at + FETCH]
        rows = (terms.where(F.col("example").between(int(some[0]), int(some[-1])))
                .select("example", F.xxhash64("term").alias("h"), "n").toArrow())
        h = rows["h"].to_numpy()
        t = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1)).astype(np.int32)
        known = keys[t] == h if len(keys) else np.zeros(len(h), bool)
        t = t[known]
        e = np.searchsorted(some, rows["example"].to_numpy()[known])
        value = (1 + np.log(rows["n"].to_numpy()[known])) * weight[t]
        norm = np.sqrt(np.bincount(e, value * value, minlength=len(some)))
        norm[norm == 0] = 1.0
        value = (value / norm[e]).astype(np.float32)
        by = np.lexsort((t, value, e))
        heavy[at + e[by]] = t[by]
        parts.append(((at + e).astype(np.int32), t, value))
        del rows, h, known, by
        pa.default_memory_pool().release_unused()
    e, t, value = zip(*parts)
    del parts
    e = np.concatenate(e)
    t = np.concatenate(t)
    return e, t, np.concatenate(value), heavy


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_examples: int = MAX_EXAMPLES,
        min_z: float = MIN_Z) -> Index:
    """Index over at most ``max_examples`` examples of each label.

    ``labels`` (doc_id, label) are the rows to learn from.  Terms and their
    frequencies are counted by Spark; the driver gets the examples' terms and
    sparse vectors.  ``min_z`` leaves terms below it out.
    """
    one = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
           .agg(F.max(F.col(label).cast("int")).alias("y")))
    one = one.where("y IN (0, 1)")
    totals = {r.y: r.n for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    pick = one.where("y = 1").orderBy(order, "doc_id").limit(max_examples).unionByName(
        one.where("y = 0").orderBy(order, "doc_id").limit(max_examples))
    # at most 2 * max_examples rows: small by the parameter
    examples = saved(docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id")
                     .select("doc_id", "text", "y", F.monotonically_increasing_id().alias("example")), "op1-examples")
    kept = examples.select("example", "doc_id", "y").orderBy("example").toArrow()
    ids, toxic = kept["doc_id"].to_pylist(), kept["y"].to_numpy().astype(float)
    size = len(ids)
    terms = saved(examples.select("example", "text").mapInArrow(_terms, "example long, term string, n long"), "op1-terms")
    stats = (terms.join(F.broadcast(examples.select("example", "y")), "example")
             .groupBy("term").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")))
    # expected counts under equal rates in both samples
    s1, s0 = max(1.0, toxic.sum()), max(1.0, size - toxic.sum())
    z = F.abs(F.col("n1") / s1 - F.col("n0") / s0) / F.sqrt((F.col("n1") + F.col("n0")) / F.lit(s1 + s0) * F.lit(1 / s1 + 1 / s0))
    chosen = (stats.select("term", F.xxhash64("term").alias("h"), z.alias("z")).where(F.col("z") >= min_z)
              .orderBy("h").toArrow())
    known = chosen["term"].combine_chunks()
    df, n_docs = document_frequencies(docs, known)
    weight = np.log((1.0 + n_docs) / (1 + df)) * chosen["z"].to_numpy()
    e, t, value, heavy = _weighted_terms(terms, kept["example"].to_numpy(), chosen["h"].to_numpy(), weight)
    del chosen, kept
    # examples with the same weightiest term stand together: block bounds are tighter then
    place = np.empty(size, np.int32)
    place[np.lexsort((toxic, heavy))] = np.arange(size)
    back = np.argsort(place)
    e = place[e]
    by = np.argsort(t * np.int64(size) + e, kind="stable")
    counts = np.bincount(t, minlength=len(known)).astype(np.int32)
    del t
    e, value = e[by], value[by]
    del by
    pa.default_memory_pool().release_unused()
    stands = np.array([totals.get(0, 0) / max(1, size - toxic.sum()), totals.get(1, 0) / max(1, toxic.sum())])
    return Index(known, weight, counts, e, value, stands[toxic.astype(int)][back] if size else np.zeros(0), toxic[back] if size else toxic,
                 [ids[i] for i in back], prior, docs.schema["doc_id"].dataType)


def _score(shared, k: int, id_type: pa.DataType):
    def run(batches):
        index = shared.value
        for batch in slices(batches, "text"):
            judged = index.judge_all([t or "" for t in batch.column("text").to_pylist()], k)
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array([s for s, _ in judged], pa.float64()),
                                                    pa.array([int(s >= 0.5) for s, _ in judged], pa.int32()),
                                                    pa.array([e for _, e in judged], pa.list_(id_type))],
                names + ["score", "predicted", "evidence"])
    return run


def score(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, score, predicted, evidence): evidence are the nearest examples' doc_ids."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _score(shared, k, to_arrow_type(index.id_type)),
        f"doc_id {kind}, score double, predicted int, evidence array<{index.id_type.simpleString()}>")


def keep_clean(docs: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(row.alias("doc"), "text")
    kind = packed.schema["doc"].dataType.simpleString()
    judged = packed.mapInArrow(_score(shared, k, to_arrow_type(index.id_type)),
                               f"doc {kind}, score double, predicted int, evidence array<{index.id_type.simpleString()}>")
    return judged.where("predicted = 0").select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fifth."""
    return labels.where(~held_out(F.col("doc_id")))


@REGISTRY("op1_toxicity_neighbours")
def op1(spark, sf_dir):
    """Toxicity score of every document, learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    index = fit(docs, training_labels(table(spark, sf_dir, "labels")))
    return score(docs, index).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
