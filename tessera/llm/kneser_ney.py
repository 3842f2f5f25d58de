"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Method: tasks count word pairs of bounded blocks of text and send them, sorted,
to the shard of the first word's hash; counts are pre-aggregated, so a frequent
pair is one entry of a block.  A shard merges its pairs, and the counts of
counts give the discounts.  The model is stored as sorted hash arrays, one raw
file for each shard: pairs with their discounted probability, first words with
their back-off weight, and in a second set of files words with their
continuation probability and count.  Nothing is pruned.  Workers memory-map
the files and find a batch's pairs by binary search.

    p(w|v) = (c(vw) - D(c(vw))) / c(v.) + g(v) p1(w)
    p1(w)  = (n(.w) - E(n(.w))) / n(..) + g1 / (V + 1)

c are counts, n numbers of distinct predecessors, D and E the discounts of
Chen and Goodman for 1, 2 and 3 or more, V the distinct words.  An unknown word
has p1 = g1 / (V + 1); after an unknown first word g is 1.

The files lie in the shared folder.  Where that is a file system every worker
mounts (``file:``), they are mapped in place; otherwise executors fetch them
once with ``addFile``.  The number of shards follows the text's bytes.

Words are 64-bit hashes.  Defined cases: a null or empty text is the end token
alone; a null doc_id is not held out; without training rows every probability
is 1; repeated rows count and score as often as they occur.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import windows as W
from tessera.llm.common import REGISTRY, _shuffles_removed, drop_saved, saved, slices, table, texts_of
from tessera.llm.toxicity import held_out
from tessera.session import scratch_path

#: Hashes of the context before a text's first word, and of its end.
BEGIN, STOP = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
BLOCK_BYTES = 6 << 20
SHARD_BYTES = 8 << 20


def sequences(column) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts laid end to end, each with STOP behind, and the texts' offsets."""
    data, offsets = texts_of(column)
    low, high = int(offsets[0]), int(offsets[-1])
    data, offsets = data[low:high], offsets - low
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + np.uint8(32), data)
    begin, end = W.word_bounds_by_text(data, offsets)
    values = W.word_values(data, begin, end)
    sizes = np.bincount(np.searchsorted(offsets, begin, side="right") - 1, minlength=len(offsets) - 1) if len(begin) \
        else np.zeros(len(offsets) - 1, np.int64)
    places = np.cumsum(sizes + 1)
    out = np.full(int(places[-1]) if len(places) else 0, STOP, np.uint64)
    inside = np.ones(len(out), bool)
    inside[places - 1] = False
    out[inside] = values
    return out, np.concatenate([[0], places]).astype(np.int64)


def contexts(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The hash before each word."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[offsets[:-1][offsets[:-1] < len(words)]] = BEGIN
    return before


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return W.mix64(context * np.uint64(0x9FB21C651E98DF25) + word)


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _grouped(context, word, count):
    """Distinct pairs sorted by (context, word), with summed counts."""
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    if not len(context):
        return context, word, count
    new = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
    return context[new], word[new], np.add.reduceat(count, new)


def _rows(shard, shards: int, *arrays):
    """(shard, bytes of each array) for runs of equal shard in sorted order."""
    edge = np.searchsorted(shard, np.arange(shards + 1))
    for s in range(shards):
        if edge[s] < edge[s + 1]:
            yield (s, *[a[edge[s]:edge[s + 1]].tobytes() for a in arrays])


def _batch(rows, names):
    rows = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32())] + [pa.array(r, pa.binary()) for r in rows[1:]], names)


def _count(shards: int):
    """Pairs of blocks of text: first words with the number of pairs each has, then words and counts."""
    names = ["shard", "first", "fan", "word", "count"]

    def flush(held):
        context, word = (np.concatenate(x) for x in zip(*held))
        context, word, count = _grouped(context, word, np.ones(len(word), np.uint32))
        new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        fan = np.diff(np.concatenate([new, [len(context)]])).astype(np.uint32)
        shard = shard_of(context, shards)
        left = _rows(shard[new], shards, context[new], fan)
        right = _rows(shard, shards, word, count.astype(np.uint32))
        return _batch([(a[0], a[1], a[2], b[1], b[2]) for a, b in zip(left, right)], names)

    def run(batches):
        held, size = [], 0
        for batch in slices(batches, "text", 1 << 20):
            words, offsets = sequences(batch.column("text"))
            held.append((contexts(words, offsets), words))
            size += len(words)
            if size * 6 >= BLOCK_BYTES:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)
    return run


PAIRS_DDL = "shard int, first binary, fan binary, word binary, count binary"
BY_WORD_DDL = "shard int, word binary, kinds binary, count binary"


def _unpack(row):
    first, word = np.frombuffer(row["first"], np.uint64), np.frombuffer(row["word"], np.uint64)
    fan, count = np.frombuffer(row["fan"], np.uint32), np.frombuffer(row["count"], np.uint32)
    return np.repeat(first, fan), word, count.astype(np.uint64)


def _merge(frame: pa.Table) -> pa.Table:
    """One row for a shard: its distinct pairs, and how many occur 1, 2, 3, 4 times."""
    parts = [_unpack(r) for r in frame.to_pylist()]
    context, word, count = _grouped(*(np.concatenate(x) for x in zip(*parts)))
    new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    fan = np.diff(np.concatenate([new, [len(context)]])).astype(np.uint32)
    of = np.bincount(np.minimum(count, 5).astype(np.int64), minlength=6)
    return pa.table({"shard": pa.array([frame["shard"][0].as_py()], pa.int32()), "first": [context[new].tobytes()], "fan": [fan.tobytes()],
                     "word": [word.tobytes()], "count": [np.minimum(count, 0xFFFFFFFF).astype(np.uint32).tobytes()],
                     "of": [of[1:5].tolist()]})


def _by_word(shards: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, word, count = _unpack(row)
                order = np.argsort(word, kind="stable")
                word, count = word[order], count[order]
                new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
                kinds = np.diff(np.concatenate([new, [len(word)]])).astype(np.uint64)
                total = np.add.reduceat(count, new) if len(new) else count
                yield _batch(_rows(shard_of(word[new], shards), shards, word[new], kinds, total), ["shard", "word", "kinds", "count"])
    return run


def _merge_words(frame: pa.Table) -> pa.Table:
    rows = frame.to_pylist()
    word, kinds, count = (np.concatenate([np.frombuffer(r[c], np.uint64) for r in rows]) for c in ("word", "kinds", "count"))
    order = np.argsort(word, kind="stable")
    word, kinds, count = word[order], kinds[order], count[order]
    new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    kinds, count, word = np.add.reduceat(kinds, new), np.add.reduceat(count, new), word[new]
    of = np.bincount(np.minimum(kinds, 5).astype(np.int64), minlength=6)
    return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int32()), "word": [word.tobytes()], "kinds": [kinds.tobytes()],
                     "count": [count.tobytes()], "of": [of[1:5].tolist()], "words": pa.array([len(word)], pa.int64()),
                     "tokens": pa.array([int(count.sum())], pa.int64()), "pairs": pa.array([int(kinds.sum())], pa.int64())})


def discounts(of) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more, from the numbers of entries with count 1 to 4.

    Chen and Goodman's estimate; where a number is zero the discount falls back
    to that of absolute discounting, within 0 and the count.
    """
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = [0.0]
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a else y
        out.append(min(max(d, 0.0), float(k)))
    return np.array(out)


def _pair_file(d: np.ndarray):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                context, word, count = _unpack(row)
                new = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
                total = np.add.reduceat(count, new).astype(float)
                off = d[np.minimum(count, 3).astype(np.int64)]
                weight = np.add.reduceat(off, new) / total
                fan = np.diff(np.concatenate([new, [len(context)]]))
                p = (count - off) / np.repeat(total, fan)
                key = pair_key(context, word)
                order = np.argsort(key)
                head = np.array([row["shard"], len(key), len(new), 0], np.uint64)
                body = b"".join(x.tobytes() for x in (head, key[order], context[new], p[order].astype(np.float32), weight.astype(np.float32)))
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["data"])
    return run


def _word_file(e: np.ndarray, pairs: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                word, kinds, count = (np.frombuffer(row[c], np.uint64) for c in ("word", "kinds", "count"))
                p = (kinds - e[np.minimum(kinds, 3).astype(np.int64)]) / pairs
                head = np.array([row["shard"], len(word), 0, 1], np.uint64)
                body = b"".join(x.tobytes() for x in (head, word, count, p))
                yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["data"])
    return run


class Model:
    """What a worker needs to find the model: file paths, shard counts and totals."""

    def __init__(self, files, local, shards, totals):
        self.files, self.local, self.shards = files, local, shards
        self.tokens, self.words, self.rest = totals

    def _open(self):
        pairs, words = {}, {}
        for path in self.files:
            path = path if self.local else SparkFiles.get(os.path.basename(path))
            data = np.memmap(path, np.uint8, "r")
            shard, n, m, kind = (int(x) for x in data[:32].view(np.uint64))
            at = 32
            parts = []
            for size, dtype in ((n, np.uint64), (n, np.uint64), (n, np.float64)) if kind else (
                    (n, np.uint64), (m, np.uint64), (n, np.float32), (m, np.float32)):
                width = size * np.dtype(dtype).itemsize
                parts.append(data[at:at + width].view(dtype))
                at += width
            (words if kind else pairs)[shard] = parts
        return pairs, words

    def opened(self):
        if not hasattr(self, "maps"):
            self.maps = self._open()
        return self.maps

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "maps"}

    def _find(self, key, shard, shards, tables, keys, value, missing, dtype):
        """``tables[shard][value]`` at each key (``missing`` where a shard lacks it)."""
        out = np.full(len(key), missing, dtype)
        order = np.lexsort((key, shard))
        edge = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            part = order[edge[s]:edge[s + 1]]
            if len(part) and s in tables:
                have = tables[s][keys]
                want = key[part]
                at = np.minimum(np.searchsorted(have, want), len(have) - 1)
                same = have[at] == want
                out[part[same]] = tables[s][value][at[same]]
        return out

    def score(self, words: np.ndarray, offsets: np.ndarray):
        """(tokens, known tokens, base score, score) of each text."""
        pairs, table_ = self.opened()
        distinct, back = np.unique(words, return_inverse=True)
        shard = shard_of(distinct, self.shards)
        count = self._find(distinct, shard, self.shards, table_, 0, 1, 0, np.uint64)[back]
        low = self._find(distinct, shard, self.shards, table_, 0, 2, 0.0, np.float64) + self.rest / (self.words + 1)
        context = contexts(words, offsets)
        shard = shard_of(context, self.shards)
        high = self._find(pair_key(context, words), shard, self.shards, pairs, 0, 2, 0.0, np.float32)
        weight = self._find(context, shard, self.shards, pairs, 1, 3, 1.0, np.float32)
        p = high.astype(float) + weight * low[back]
        base = np.log10((count.astype(float) + 1) / (self.tokens + self.words + 1))
        add = lambda x: np.add.reduceat(x, offsets[:-1]) if len(offsets) > 1 else np.zeros(0, x.dtype)
        return np.diff(offsets), add((count > 0).astype(np.int64)), add(base), add(np.log10(p))


def _write(files: DataFrame, path: str) -> None:
    """One raw file for each row."""
    with _shuffles_removed(files.sparkSession):
        files.select(F.col("data").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def train(docs: DataFrame) -> Model:
    """Count ``text`` of ``docs`` and store the model in the shared folder."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0].n or 0
    shards = max(1, -(-size // SHARD_BYTES))
    pairs = saved(docs.select("text").mapInArrow(_count(shards), PAIRS_DDL).groupBy("shard").applyInArrow(
        _merge, PAIRS_DDL + ", of array<long>"), "op10-pairs")
    words = saved(pairs.select("shard", "first", "fan", "word", "count").mapInArrow(_by_word(shards), BY_WORD_DDL).groupBy("shard").applyInArrow(
        _merge_words, BY_WORD_DDL + ", of array<long>, words long, tokens long, pairs long"), "op10-words")
    counts_of = lambda df: [df.agg(F.sum(F.get("of", F.lit(i)))).collect()[0][0] or 0 for i in range(4)]
    d, e = discounts(counts_of(pairs)), discounts(counts_of(words))
    total = words.agg(*[F.sum(c).alias(c) for c in ("words", "tokens", "pairs")]).collect()[0]
    vocabulary, tokens, kinds = (x or 0 for x in total)
    path = scratch_path(spark, "op10-model")
    _write(pairs.select("shard", "first", "fan", "word", "count").mapInArrow(_pair_file(d), "data binary"), path + "/pairs")
    _write(words.select("shard", "word", "kinds", "count").mapInArrow(_word_file(e, max(1, kinds)), "data binary"), path + "/words")
    # what the lowest order's discounts leave: found from the stored probabilities' complement
    by_kind = counts_of(words)
    more = vocabulary - by_kind[0] - by_kind[1]
    rest = (e[1] * by_kind[0] + e[2] * by_kind[1] + e[3] * more) / kinds if kinds else 1.0
    drop_saved(pairs, words)
    return Model(*_published(spark, path), shards, (tokens, vocabulary, rest))


def _published(spark, path: str) -> tuple[list[str], bool]:
    """The model's files, and whether workers map them in place."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.deleteOnExit(root)
    files = []
    for part in ("pairs", "words"):
        for status in fs.listStatus(sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")):
            if status.getLen() > 1 and status.getPath().getName().startswith("part-"):
                files.append(status.getPath())
    if fs.getUri().getScheme() == "file":
        return [f.toUri().getPath() for f in files], True
    for f in files:
        sc.addFile(f.toString())
    return [f.getName() for f in files], False


SCORES = ("n_tokens", "n_known", "base_score", "score")


def _score(model: Model):
    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            n, known, base, total = model.score(*sequences(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(total)],
                ["doc_id", *SCORES])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        _score(model), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


@REGISTRY("op10_kneser_ney")
def op10(spark, sf_dir):
    """Log10 probabilities of every document under the model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    model = train(docs.where(~out))
    return score(docs, model).select("doc_id", out.alias("held_out"), "n_tokens", "n_known",
                                     F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
