"""Centred-cosine similarity between users (or items) and top-k neighbours.

Let ``entity`` be the side being compared (user for user-user) and
``feature`` the other side.  For each entity, ``mean = sum / n`` (plain
mean, so a constant rater centres to exact zeros), ``c = r - mean`` and
``norm = sqrt(sum c^2)``.  Similarity over co-rated features is

    sim(a, b) = sum_f c_af * c_bf / (norm_a + EPS) / (norm_b + EPS)

Rows with ``c == 0`` add nothing to any sum and are dropped first.

The sums are a sparse Gram product, computed in blocks: entities are dealt into
blocks of about ``block``, and a task meets two of them.  It adds up all
products of its pairs locally, feature by feature, so that a row leaves it for
each co-rated pair and not for each co-rating.  What is shuffled is every
rating once for each block, whatever the degrees of the features.  Where two
blocks hold more than ``TASK_ROWS`` ratings, the features are dealt into parts
as well and the parts' sums added, so neither a hot feature nor a hot entity
fills a task.  For top-k neighbours a task passes on at most about k partners of
an entity from each block, and their count.

Where entities share few features, most ratings would go to blocks that hold no
partner of theirs.  Top-k neighbours then go by feature: a block of entities meets
the raters of the features it rated and no others, and forms the products of one
entity after another.  A rating goes to each block at most once, and to no more
blocks than its feature has raters.  Which way is taken follows from counting the
rows that either would send; where a block would meet more than ``MET_ROWS`` ratings,
blocks are cut smaller, and if that does not help they are left to the blocks above.
Blocks are taken in rounds, so that what lies shuffled at a time follows the ratings and
not the ratings times their features' raters.  All partners of an entity come together in
its block's task, which ranks them and lets out no more than is asked for: neighbours
(:func:`nearest`), sums for given pairs (:func:`predicted`) or the best features (:func:`best`).
"""

from __future__ import annotations

import decimal
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.plans.sizing import broadcast_if_small
from tessera.session import drop_written, written

EPS = 1e-9
#: Entities of a block: a task holds block x block sums and counts (12 bytes each).
BLOCK = 2048
#: Ratings of two blocks that one task takes.
TASK_ROWS = 4_000_000
#: Products that are formed at a time.
PRODUCTS = 1_000_000
#: Partners nearer than this to the k-th stay: ``top_k`` ranks by 9 decimals.
SLACK = 2e-9
#: Ratings of the entities of one block, where blocks meet the raters of their features.
OWN_ROWS = 100_000
#: Ratings that such a block may meet.
MET_ROWS = 8_000_000
#: Raters in a list of a feature.
LIST_ROWS = 100_000
#: Ratings that one round sends to blocks, or this many times the ratings if they are more.
ROUND_ROWS, ROUND_TIMES = 30_000_000, 2


def entity_stats(train: DataFrame, entity: str) -> DataFrame:
    """Per entity: n, plain mean, EPS-average and centred L2 norm (one pass).

    ``sum (r - mean)^2 = sum r^2 - (sum r)^2 / n``; the map-side partial
    aggregate makes a hot entity as cheap as any other.
    """
    s, ss, n = F.col("_s"), F.col("_ss"), F.col("_n")
    return (train.groupBy(entity)
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_s"),
                 F.sum(F.col("rating") * F.col("rating")).alias("_ss"))
            .select(entity, n.alias("n"), (s / n).alias("mean"),
                    (s / (n + F.lit(EPS))).alias("avg"),
                    F.sqrt(F.greatest(ss - s * s / n, F.lit(0.0))).alias("norm")))


def centered(train: DataFrame, entity: str, feature: str,
             stats: DataFrame | None = None) -> DataFrame:
    """(entity, feature, c, cn) with c = r - mean != 0 and cn = c / (norm + EPS)."""
    st = stats if stats is not None else entity_stats(train, entity)
    c = F.col("rating") - F.col("mean")
    return (train.select(entity, feature, "rating")
            .join(broadcast_if_small(st.select(entity, "mean", "norm")), entity)
            .select(entity, feature, c.alias("c"),
                    (c / (F.col("norm") + F.lit(EPS))).alias("cn"))
            .where(F.col("c") != 0))


def _runs(keys: np.ndarray, n: int) -> np.ndarray:
    """Start of each key's run in sorted ``keys`` (0 .. n - 1), and the end."""
    return np.searchsorted(keys, np.arange(n + 1))


def _products(left: tuple, right: tuple, n_features: int, shape: tuple, upper: bool):
    """(sums, counts) of the products of two blocks, flat over ``shape``.

    A side is (feature, entity, value) by feature; ``upper`` keeps pairs of
    ascending entities, where both sides are the same block.
    """
    lf, le, lv = left
    rf, re, rv = right
    starts = _runs(rf, n_features)
    partners = np.diff(starts)[lf]
    done = np.cumsum(partners)
    sums, counts = np.zeros(shape[0] * shape[1]), np.zeros(shape[0] * shape[1], np.int32)
    at = 0
    while at < len(lf):
        end = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PRODUCTS, side="right")))
        n = partners[at:end]
        each = np.repeat(np.arange(at, end), n)
        other = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + starts[lf[each]]
        if upper:
            ok = le[each] < re[other]
            each, other = each[ok], other[ok]
        cell = le[each] * shape[1] + re[other]
        sums += np.bincount(cell, weights=lv[each] * rv[other], minlength=len(sums))
        counts += np.bincount(cell, minlength=len(counts)).astype(np.int32)
        at = end
    return sums, counts


def _pairs_of_blocks(t: pa.Table):
    """((entities, targets) of each side, sums, counts) of the blocks i and j of a task."""
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    block, value, wanted = (t.column(c).to_numpy() for c in ("block", "cn", "target"))
    names = t.column("entity").combine_chunks().dictionary_encode()
    features = t.column("feature").combine_chunks().dictionary_encode()
    entity, feature = names.indices.to_numpy(), features.indices.to_numpy()

    def side(b):
        at = np.flatnonzero(block == b)
        at = at[np.argsort(feature[at], kind="stable")]
        own, first, local = np.unique(entity[at], return_index=True, return_inverse=True)
        return (feature[at], local, value[at]), (names.dictionary.take(pa.array(own)), wanted[at][first])
    left, a = side(i)
    right, b = (left, a) if i == j else side(j)
    shape = len(a[0]), len(b[0])
    return (a, b), _products(left, right, len(features.dictionary), shape, i == j), shape


def _summed(t: pa.Table) -> pa.Table:
    """Unordered pairs that hold a target, with the task's share of their sum."""
    (a, b), (sums, counts), shape = _pairs_of_blocks(t)
    x, y = np.divmod(np.flatnonzero(counts), shape[1])
    keep = a[1][x] | b[1][y]
    x, y = x[keep], y[keep]
    one, two, sim, ta, tb = a[0].take(pa.array(x)), b[0].take(pa.array(y)), sums[x * shape[1] + y], a[1][x], b[1][y]
    if a is b:  # the local order of one block's entities is the task's own: name pairs alike in all parts
        turn = pc.greater(one, two)
        one, two = pc.if_else(turn, two, one), pc.if_else(turn, one, two)
        turn = turn.to_numpy(zero_copy_only=False)
        ta, tb = np.where(turn, tb, ta), np.where(turn, ta, tb)
    return pa.table({"a": one, "b": two, "sim": sim, "ta": pa.array(ta), "tb": pa.array(tb)})


def _nearest(k: int):
    """(a, b, sim, n): the pairs of each target a that can be among its k first, and a row with their count."""
    def run(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        (a, b), (sums, counts), shape = _pairs_of_blocks(t)
        cells = np.flatnonzero(counts)
        x, y = np.divmod(cells, shape[1])
        sim = sums[cells]
        out = []
        # each side in turn; within one block every pair has both ways
        ways = [(a, b, x, y, sim)] + ([(b, a, y, x, sim)] if i != j else [])
        if i == j:
            ways = [(a, a, np.r_[x, y], np.r_[y, x], np.r_[sim, sim])]
        for (own, wanted), (others, _), p, q, s in ways:
            keep = wanted[p]
            p, q, s = p[keep], q[keep], s[keep]
            order = np.lexsort((-s, p))
            p, q, s = p[order], q[order], s[order]
            starts = _runs(p, len(own))
            n = np.diff(starts)
            last = np.where(n > k, s[np.minimum(starts[:-1] + k - 1, max(len(s) - 1, 0))] if len(s) else 0.0, -np.inf)
            near = s >= last[p] - SLACK
            out.append(pa.table({"a": own.take(pa.array(p[near])), "b": others.take(pa.array(q[near])), "sim": s[near],
                                 "n": pa.nulls(int(near.sum()), pa.int64())}))
            some = np.flatnonzero(n)
            out.append(pa.table({"a": own.take(pa.array(some)), "b": pa.nulls(len(some), others.type), "sim": pa.nulls(len(some), pa.float64()),
                                 "n": pa.array(n[some])}))
        return pa.concat_tables(out)
    return run


def _rows(cent: DataFrame, entity: str, feature: str, targets: DataFrame | None) -> DataFrame:
    """(entity, feature, cn, target): the ratings, and whether their entity is asked for."""
    rows = cent.select(F.col(entity).alias("entity"), F.col(feature).alias("feature"), "cn")
    if targets is None:
        rows = rows.withColumn("target", F.lit(True))
    else:
        asked = targets.select(F.col(entity).alias("entity")).distinct().withColumn("target", F.lit(True))
        rows = (rows.join(broadcast_if_small(asked), "entity", "left")
                .withColumn("target", F.coalesce("target", F.lit(False))))
    return rows


def _dealt(cent: DataFrame, entity: str, feature: str, targets: DataFrame | None, block: int, task_rows: int):
    """(ratings sent to every pair of blocks that holds theirs, parts of the features)."""
    rows = _rows(cent, entity, feature, targets)
    n_entities = rows.agg(F.approx_count_distinct("entity", 0.02)).collect()[0][0]
    n_blocks = max(1, -(-n_entities // block))
    mine = F.pmod(F.xxhash64("entity"), F.lit(n_blocks)).cast("int")
    largest = rows.groupBy(mine.alias("block")).count().agg(F.max("count")).collect()[0][0] or 0
    parts = max(1, -(-2 * largest // task_rows))
    part = F.pmod(F.xxhash64("feature", F.lit(1)), F.lit(parts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    sent = (rows.withColumn("block", mine).withColumn("part", part).withColumn("other", every)
            .select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "part", "block", "entity", "feature", "cn", "target"))
    return sent.groupBy("i", "j", "part"), parts, rows.schema["entity"].dataType.simpleString()


def _sums_of(codes: np.ndarray, at: np.ndarray, values: np.ndarray, starts: np.ndarray, partner: np.ndarray, weight: np.ndarray, n_partners: int,
             plain: bool = False):
    """(entity, partner, sum) of entity after entity, in pieces of about ``PRODUCTS`` products.

    An entity's ratings are ``at[e]`` to ``at[e + 1]``: rows of ``codes`` (feature)
    and ``values``; the raters of a feature lie from its ``starts`` on.  ``plain`` adds
    the sum of the values without the weights.
    """
    n = np.diff(starts)[codes]
    done = np.r_[0, np.cumsum(n)]

    def products(lo, hi):
        each = np.repeat(np.arange(lo, hi), n[lo:hi])
        other = np.arange(len(each)) - np.repeat(done[lo:hi] - done[lo], n[lo:hi]) + starts[codes[each]]
        v = values[each]
        return each, partner[other], v * weight[other], v if plain else None

    e = 0
    while e < len(at) - 1:
        end = max(e + 1, int(np.searchsorted(done[at], done[at[e]] + PRODUCTS, side="right")) - 1)
        lo, hi = at[e], at[end]
        if end == e + 1:  # one entity, however many products it has
            sums, totals, counts = np.zeros(n_partners), np.zeros(n_partners), np.zeros(n_partners, bool)
            while lo < hi:
                to = max(lo + 1, min(hi, int(np.searchsorted(done, done[lo] + PRODUCTS, side="right")) - 1))
                _, q, x, v = products(lo, to)
                sums += np.bincount(q, weights=x, minlength=n_partners)
                if plain:
                    totals += np.bincount(q, weights=v, minlength=n_partners)
                counts[q] = True
                lo = to
            q = np.flatnonzero(counts)
            p, s, v = np.full(len(q), e), sums[q], totals[q]
        else:
            each, q, x, v = products(lo, hi)
            cell = (np.searchsorted(at, each, side="right") - 1 - e) * n_partners + q
            order = np.argsort(cell, kind="stable")
            cell, x = cell[order], x[order]
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][:len(cell)])
            s = np.add.reduceat(x, first) if len(first) else x
            if plain:
                v = np.add.reduceat(v[order], first) if len(first) else v
            p, q = np.divmod(cell[first], n_partners)
            p += e
        yield (p, q, s, v) if plain else (p, q, s)
        e = end


def _coded(own: pa.Table, met: pa.Table):
    """A block's rows and the lists it met, with features and entities as numbers.

    Gives the ids of the entities, the (entity, feature, value) of the block's ratings by
    entity and of the rows asked for, and of both kinds of lists the (starts by feature,
    entity, value).  Own entities have the first numbers.
    """
    def kinds(t):
        asked = t.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        return [t if asked.all() == k and len(t) and asked.any() == k else t.filter(pa.array(asked == k)) for k in (False, True)]
    rows, lists = kinds(own), kinds(met)
    features = pa.concat_arrays([t.column(c).combine_chunks() for ts, c in ((rows, "feature"), (lists, "met")) for t in ts]).dictionary_encode()
    n = len(features.dictionary)
    feature = np.split(features.indices.to_numpy(), np.cumsum([len(t) for t in rows + lists])[:-1])
    sides = []
    for t, f in zip(lists, feature[2:]):
        order = np.argsort(f, kind="stable")
        t, f = t.take(pa.array(order)), f[order]
        each = t.column("entities").combine_chunks()
        length = each.value_lengths().to_numpy()
        starts = np.r_[0, np.cumsum(np.bincount(f, weights=length, minlength=n).astype(np.int64))]
        sides.append((starts, each.flatten(), t.column("cns").combine_chunks().flatten().to_numpy()))
    parts = [t.column("entity").combine_chunks() for t in rows] + [x[1] for x in sides]
    names = pa.concat_arrays(parts).dictionary_encode()
    code = np.split(names.indices.to_numpy(), np.cumsum([len(x) for x in parts])[:-1])
    given = []
    for t, e, f in zip(rows, code, feature):
        order = np.argsort(e, kind="stable")
        given.append((e[order], f[order], t.column("cn").to_numpy()[order]))
    return names.dictionary, given, [(x[0], c, x[2]) for x, c in zip(sides, code[2:])]


def _ends(sorted_codes: np.ndarray, n: int) -> np.ndarray:
    return np.r_[0, np.cumsum(np.bincount(sorted_codes, minlength=n))]


def _rounded(x: np.ndarray) -> np.ndarray:
    """``F.round(x, 9)``: half away from zero in the shortest decimal form of a number."""
    scaled = np.abs(x) * 1e9
    up = np.floor(scaled + 0.5)
    out = np.copysign(up / 1e9, x)
    for n in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
        out[n] = float(decimal.Decimal(repr(float(x[n]))).quantize(decimal.Decimal("1e-9"), decimal.ROUND_HALF_UP))
    return out


def _first(p: np.ndarray, q: np.ndarray, s: np.ndarray, k: int, n_all: int, by_id: np.ndarray, ranked: bool):
    """(entity, partner, sum, rank) of what :func:`top_k` keeps; ``p`` ascends and has all its partners here.

    Without ``ranked`` ranks are found only where they decide and the rows stay in order.
    """
    start = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    n = np.diff(np.r_[start, len(p)])
    of = np.repeat(np.arange(len(start)), n)
    n_pos = np.add.reduceat((s > 0).astype(np.int64), start)
    n_neg = np.add.reduceat((s < 0).astype(np.int64), start)
    behind = n_all - 1 - n_neg                        # dense rank of an entity's first negative, less 1
    negative = behind < k
    sort = np.full(len(start), ranked) | (n_pos > k) | (negative & (n_neg > 0))
    rows = np.flatnonzero((s > 0) | ((s < 0) & negative[of]))
    rank = np.zeros(len(p), np.int64)
    free = ~sort[of[rows]]
    kept = [rows[free]]
    for sign, first, before in ((1, np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)), (-1, behind, n - n_neg)):
        at = rows[~free]
        at = at[s[at] * sign > 0]
        if not len(at):
            continue
        # the k greatest of each, with slack, and then in their exact order
        many = np.bincount(of[at], minlength=len(start)) > k
        if many.any():
            at = at[np.lexsort((-s[at], of[at]))]
            ends = _ends(of[at], len(start))
            cut = np.where(many, s[at[np.minimum(ends[:-1] + k - 1, len(at) - 1)]], -np.inf)
            at = at[s[at] >= cut[of[at]] - SLACK]
        at = at[np.lexsort((by_id[q[at]], -_rounded(s[at]), of[at]))]
        place = np.arange(len(at)) - _ends(of[at], len(start))[of[at]] + 1
        rank[at] = place + first[of[at]]
        ok = (rank[at] <= k) & (place + before[of[at]] <= k)
        kept.append(at[ok])
    kept = np.sort(np.concatenate(kept))
    return p[kept], q[kept], s[kept], rank[kept]


def _nearest_met(k: int, n_all: int | None, kind):
    """As :func:`_nearest`, of a block's own ratings and the raters of their features."""
    types = pa.schema([("a", kind), ("b", kind), ("sim", pa.float64()), ("n", pa.int64())])

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        if not len(own) or not len(met):
            return types.empty_table()
        ids, ((entity, feature, value), _), ((starts, partner, weight), _) = _coded(own, met)
        out = []
        for p, q, s in _sums_of(feature, _ends(entity, 0), value, starts, partner, weight, len(ids)):
            other = p != q
            p, q, s = p[other], q[other], s[other]
            if not len(p):
                continue
            own_e, n = np.unique(p, return_counts=True)
            count = np.zeros(own_e[-1] + 1, np.int64)
            count[own_e] = n
            if n_all is not None:  # others than positives rank only where the entities without a common feature leave places
                keep = (s > 0) | (n_all - 1 - count[p] < k)
                p, q, s = p[keep], q[keep], s[keep]
            order = np.lexsort((-s, p))
            p, q, s = p[order], q[order], s[order]
            first = np.searchsorted(p, p)
            last = first + k - 1
            cut = np.where((last < len(p)) & (p[np.minimum(last, len(p) - 1)] == p), s[np.minimum(last, len(p) - 1)], -np.inf) if len(p) else s
            near = s >= cut - SLACK
            out.append(pa.table([ids.take(pa.array(p[near])), ids.take(pa.array(q[near])), pa.array(s[near]), pa.nulls(int(near.sum()), pa.int64())], schema=types))
            out.append(pa.table([ids.take(pa.array(own_e)), pa.nulls(len(own_e), ids.type), pa.nulls(len(own_e), pa.float64()), pa.array(n)], schema=types))
        return pa.concat_tables(out) if out else types.empty_table()
    return run


def _ranked_met(k: int, n_all: int, kind):
    """(a, b, sim, rank): the neighbours of a block's entities."""
    types = pa.schema([("a", kind), ("b", kind), ("sim", pa.float64()), ("rank", pa.int64())])

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        if not len(own) or not len(met):
            return types.empty_table()
        ids, ((entity, feature, value), _), ((starts, partner, weight), _) = _coded(own, met)
        by_id = _order(ids)
        out = []
        for p, q, s in _sums_of(feature, _ends(entity, 0), value, starts, partner, weight, len(ids)):
            other = p != q
            if other.any():
                p, q, s, rank = _first(p[other], q[other], s[other], k, n_all, by_id, True)
                out.append(pa.table([ids.take(pa.array(p)), ids.take(pa.array(q)), pa.array(s), pa.array(rank)], schema=types))
        return pa.concat_tables(out) if out else types.empty_table()
    return run


def _order(ids: pa.Array) -> np.ndarray:
    """Each id's place in ascending order."""
    place = np.empty(len(ids), np.int64)
    place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return place


def _predicted_met(k: int, n_all: int, kind, other_kind):
    """(entity, feature, num, den): sum of sim x value and of sim over the neighbours that rated the feature, of each row asked for."""
    types = pa.schema([("entity", kind), ("feature", other_kind), ("num", pa.float64()), ("den", pa.float64())])

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        asked = own.filter(own.column("asked"))
        if not len(asked) or not len(met) or len(asked) == len(own):
            return types.empty_table()
        ids, ((entity, feature, value), (entity_a, feature_a, place)), ((starts, partner, weight), (starts_a, partner_a, value_a)) = _coded(own, met)
        n_ids, by_id = len(ids), _order(ids)
        raters = np.diff(starts_a)[feature_a]
        done = np.r_[0, np.cumsum(raters)]
        num, den, hit = np.zeros(len(entity_a)), np.zeros(len(entity_a)), np.zeros(len(entity_a), bool)
        for p, q, s in _sums_of(feature, _ends(entity, 0), value, starts, partner, weight, n_ids):
            other = p != q
            if not other.any():
                continue
            lo, hi = np.searchsorted(entity_a, [p[0], p[-1] + 1])
            if lo == hi:
                continue
            p, q, s, _ = _first(p[other], q[other], s[other], k, n_all, by_id, False)
            if not len(p):
                continue
            near = p * n_ids + q                     # ascending
            while lo < hi:                           # rows asked for meet the raters of their feature, about PRODUCTS at a time
                to = max(lo + 1, min(hi, int(np.searchsorted(done, done[lo] + PRODUCTS, side="right")) - 1))
                each = np.repeat(np.arange(lo, to), raters[lo:to])
                at = np.arange(len(each)) - np.repeat(done[lo:to] - done[lo], raters[lo:to]) + starts_a[feature_a[each]]
                pair = entity_a[each].astype(np.int64) * n_ids + partner_a[at]
                found = np.minimum(np.searchsorted(near, pair), len(near) - 1)
                ok = near[found] == pair
                each, sim = each[ok] - lo, s[found[ok]]
                num[lo:to] += np.bincount(each, sim * value_a[at[ok]], to - lo)
                den[lo:to] += np.bincount(each, sim, to - lo)
                hit[lo + each] = True
                lo = to
        at = np.flatnonzero(hit)
        rows = asked.take(pa.array(place[at].astype(np.int64)))
        return pa.table([rows.column("entity"), rows.column("feature"), pa.array(num[at]), pa.array(den[at])], schema=types)

    def numbered(own: pa.Table, met: pa.Table) -> pa.Table:
        # a row asked for has its place among them as its value
        asked = own.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        value = np.where(asked, np.cumsum(asked) - 1.0, own.column("cn").fill_null(0.0).to_numpy())
        return run(own.set_column(own.schema.get_field_index("cn"), "cn", pa.array(value)), met)
    return numbered


def _best_met(n: int, kind, item_kind):
    """(entity, feature, pred, den, rank): the ``n`` best features an entity has not rated, from its neighbours (``cn`` their sim) and what they rated.

    Lists of kind ``asked`` hold the first features there are, in order, one a list under their id;
    rows of that kind are the features an entity rated, and one with its average, without a feature.
    """
    types = pa.schema([("entity", kind), ("feature", item_kind), ("pred", pa.float64()), ("den", pa.float64()), ("rank", pa.int64())])

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        asked = own.column("asked")
        near, rated = own.filter(pc.invert(asked)), own.filter(asked)
        users = rated.filter(pc.is_null(rated.column("item")))
        rated = rated.filter(pc.is_valid(rated.column("item")))
        if not len(users):
            return types.empty_table()
        firsts = met.filter(met.column("asked")).column("entities").combine_chunks().flatten()
        met = met.filter(pc.invert(met.column("asked")))
        order = np.argsort(pc.index_in(met.column("met"), value_set=pc.unique(met.column("met"))).to_numpy(), kind="stable") if len(met) else np.zeros(0, np.int64)
        met = met.take(pa.array(order))
        lists = met.column("entities").combine_chunks()
        items = pa.concat_arrays([lists.flatten(), rated.column("item").combine_chunks(), firsts]).dictionary_encode()
        code = items.indices.to_numpy().astype(np.int64)
        ids, n_items = items.dictionary, max(len(items.dictionary), 1)
        item_order = _order(ids)
        n_met = len(lists.flatten())
        partner, mine, first_codes = code[:n_met], code[n_met:n_met + len(rated)], code[n_met + len(rated):]
        first_codes = first_codes[np.argsort(item_order[first_codes], kind="stable")]
        at_first = np.full(n_items, -1, np.int64)
        at_first[first_codes] = np.arange(len(first_codes))
        names = users.column("entity").combine_chunks()
        avg = users.column("cn").to_numpy()
        by = lambda t: pc.index_in(t.column("entity"), value_set=names).to_numpy(zero_copy_only=False)
        taken = np.unique(by(rated).astype(np.int64) * n_items + mine)
        # neighbours by user; their lists as features
        known = pc.unique(met.column("met")) if len(met) else near.column("feature").combine_chunks()[:0]
        f = pc.index_in(near.column("feature"), value_set=known)
        here = pc.is_valid(f)
        near, f = near.filter(here), f.filter(here).to_numpy().astype(np.int64)
        u = by(near).astype(np.int64)
        order = np.argsort(u, kind="stable")
        u, f, sim = u[order], f[order], near.column("cn").to_numpy()[order]
        which = pc.index_in(met.column("met"), value_set=known).to_numpy().astype(np.int64) if len(met) else np.zeros(0, np.int64)
        starts = np.r_[0, np.cumsum(np.bincount(which, weights=lists.value_lengths().to_numpy(), minlength=len(known)).astype(np.int64))]
        weight = met.column("cns").combine_chunks().flatten().to_numpy()
        out, settled = [], 0

        def settle(lo, hi, p, q, ratio, den):
            """The lists of the users lo to hi, of whose neighbours' features (p, q) are the sums."""
            cell = p * n_items + q
            pos = np.minimum(np.searchsorted(taken, cell), max(len(taken) - 1, 0))
            new = taken[pos] != cell if len(taken) else np.ones(len(cell), bool)
            p, q, ratio, den = p[new], q[new], ratio[new], den[new]
            mine = taken[np.searchsorted(taken, lo * n_items):np.searchsorted(taken, hi * n_items)]
            both_p, both_q = np.r_[p, mine // n_items], np.r_[q, mine % n_items]
            ahead = at_first[both_q] >= 0
            both_p, both_at = both_p[ahead], at_first[both_q[ahead]]
            order = np.argsort(both_p, kind="stable")
            both_p, both_at = both_p[order], both_at[order]
            ends = np.searchsorted(both_p, np.arange(lo, hi + 1))
            fill_p, fill_q = [], []
            for e in range(lo, hi):
                had = both_at[ends[e - lo]:ends[e - lo + 1]]
                there = np.zeros(min(len(first_codes), len(had) + n), bool)
                there[had[had < len(there)]] = True
                free = np.flatnonzero(~there)[:n]
                fill_p.append(np.full(len(free), e))
                fill_q.append(first_codes[free])
            fill_p, fill_q = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (fill_p, fill_q))
            enough = np.bincount(fill_p - lo, minlength=hi - lo) >= n
            worth = (ratio > -SLACK) | ~enough[p - lo]
            p, q, ratio, den = p[worth], q[worth], ratio[worth], den[worth]
            p, q, den = np.r_[p, fill_p], np.r_[q, fill_q], np.r_[den, np.zeros(len(fill_p))]
            pred = np.r_[avg[p[:len(ratio)]] + ratio, avg[fill_p]]
            order = np.lexsort((-pred, p))
            p, q, pred, den = p[order], q[order], pred[order], den[order]
            ends = np.searchsorted(p, np.arange(lo, hi + 1))
            many = np.diff(ends) > n
            cut = np.where(many, pred[np.minimum(ends[:-1] + n - 1, max(len(pred) - 1, 0))] if len(pred) else 0.0, -np.inf)
            keep = pred >= cut[p - lo] - SLACK
            p, q, pred, den = p[keep], q[keep], pred[keep], den[keep]
            order = np.lexsort((item_order[q], -_rounded(pred), p))
            p, q, pred, den = p[order], q[order], pred[order], den[order]
            rank = np.arange(len(p)) - np.searchsorted(p, p) + 1
            keep = rank <= n
            out.append(pa.table([names.take(pa.array(p[keep])), ids.take(pa.array(q[keep])), pa.array(pred[keep]), pa.array(den[keep]), pa.array(rank[keep])], schema=types))

        none = np.zeros(0, np.int64)
        for p, q, s, d in _sums_of(f, _ends(u, len(names)), sim, starts, partner, weight, n_items, plain=True):
            if len(p):
                hi = int(p[-1]) + 1
                settle(settled, hi, p, q, s / (d + EPS), d)
                settled = hi
        settle(settled, len(names), none, none, np.zeros(0), np.zeros(0))
        return pa.concat_tables(out)
    return run


class _Blocks:
    """Blocks of entities and the lists of the features they want, to be met in rounds."""

    def __init__(self, own: DataFrame, lists: DataFrame, n_blocks: int, sent: int, n_rows: int):
        self.own, self.lists = own, lists
        self.rounds = min(n_blocks, -(-sent // max(ROUND_ROWS, ROUND_TIMES * n_rows)) or 1)

    def run(self, task, schema: str, name: str) -> DataFrame:
        """``task`` of every block, written round by round."""
        i = F.col("i")

        def part(r: int) -> DataFrame:
            here = lambda x: F.pmod(x, F.lit(self.rounds)) == r
            lists = self.lists.withColumn("i", F.explode(F.filter("wants", here))).drop("wants")
            return self.own.where(here(i)).groupBy("i").cogroup(lists.groupBy("i")).applyInArrow(task, schema)
        done = [written(part(r), name) for r in range(self.rounds)]
        drop_written(self.lists)
        return functools.reduce(DataFrame.unionByName, done)


def _lists(rows: DataFrame, key: str, entity: str, value: str, hot: int) -> DataFrame:
    """(key, entities, cns): what each key holds, in lists of about ``LIST_ROWS``."""
    part = F.pmod(F.xxhash64(entity, F.lit(1)), F.lit(-(-hot // LIST_ROWS) or 1))
    return (rows.groupBy(key, part.alias("part")).agg(F.collect_list(F.struct(F.col(entity).alias("e"), F.col(value).alias("v"))).alias("l"))
            .select(key, F.col("l.e").alias("entities"), F.col("l.v").alias("cns")))


def _blocks(cent: DataFrame, entity: str, feature: str, targets: DataFrame | None, block: int, own_rows: int, met_rows: int,
            asked: DataFrame | None = None, vals: DataFrame | None = None) -> _Blocks | None:
    """Blocks that meet the raters of their features; None where pairs of blocks are cheaper or needed.

    ``asked`` (entity, feature) are rows whose feature's raters and their values come from
    ``vals`` (entity, feature, v) as lists of their own.
    """
    rows = _rows(cent, entity, feature, targets).where("feature IS NOT NULL")
    n_rows, n_entities = rows.agg(F.count(F.lit(1)), F.approx_count_distinct("entity", 0.02)).collect()[0]
    pairs_of = -(-n_entities // block)
    if pairs_of < 2:
        return None
    for shorter in (1, 2, 4, 8):
        n_blocks = -(-n_rows // max(1, own_rows // shorter))
        mine = F.pmod(F.xxhash64("entity"), F.lit(n_blocks)).cast("int")
        wants = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.when(F.col("target"), mine)).alias("wants"), F.lit(False).alias("asked"))
        if asked is not None:
            raters = vals.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
            wants = wants.unionByName(asked.groupBy("feature").agg(F.collect_set(mine).alias("wants")).join(raters, "feature")
                                      .select("feature", "n", "wants", F.lit(True).alias("asked")))
        wants = written(wants, "cf-features")
        sent = wants.select(F.explode("wants").alias("i"), "n").groupBy("i").agg(F.sum("n").alias("met"), F.max("n").alias("hot"))
        sent = sent.agg(F.sum("met").alias("sent"), F.max("met").alias("met"), F.max("hot").alias("hot")).collect()[0]
        if sent.sent is not None and sent.sent <= n_rows * pairs_of and sent.met <= met_rows:
            break
        drop_written(wants)
        if sent.sent is None or sent.sent > n_rows * pairs_of or sent.hot > met_rows:
            return None
    else:
        return None

    def listed(df, value, kind):
        return (_lists(df, "feature", "entity", value, sent.hot).join(wants.where((F.size("wants") > 0) & (F.col("asked") == kind)), "feature")
                .select(F.col("feature").alias("met"), "entities", "cns", "wants", "asked"))
    lists = listed(rows, "cn", False)
    own = rows.where("target").select(mine.alias("i"), "entity", "feature", "cn", F.lit(False).alias("asked"))
    if asked is not None:
        lists = lists.unionByName(listed(vals, "v", True))
        own = own.unionByName(asked.select(mine.alias("i"), "entity", "feature", F.lit(None).cast("double").alias("cn"), F.lit(True).alias("asked")))
    lists = written(lists, "cf-lists")
    drop_written(wants)
    return _Blocks(own, lists, n_blocks, sent.sent, n_rows)


def _by_feature(cent: DataFrame, entity: str, feature: str, targets: DataFrame | None, k: int, block: int, n_all: int | None,
                own_rows: int, met_rows: int) -> DataFrame | None:
    """:func:`candidates` of blocks that meet the raters of their features; None where pairs of blocks are cheaper or needed."""
    blocks = _blocks(cent, entity, feature, targets, block, own_rows, met_rows)
    if blocks is None:
        return None
    kind = cent.schema[entity].dataType
    return blocks.run(_nearest_met(k, n_all, to_arrow_type(kind)), f"a {kind.simpleString()}, b {kind.simpleString()}, sim double, n long", "cf-near")


def nearest(cent: DataFrame, entity: str, feature: str, k: int, n_all: int, targets: DataFrame | None = None,
            chunk: int = BLOCK, own_rows: int | None = None, met_rows: int | None = None) -> DataFrame | None:
    """(a, b, sim, rank) as :func:`top_k`, ranked in the tasks that form the sums; None where features do not lead to the partners cheaply."""
    blocks = _blocks(cent, entity, feature, targets, chunk, own_rows or OWN_ROWS, met_rows or MET_ROWS)
    if blocks is None:
        return None
    kind = cent.schema[entity].dataType
    return blocks.run(_ranked_met(k, n_all, to_arrow_type(kind)), f"a {kind.simpleString()}, b {kind.simpleString()}, sim double, rank long", "cf-near")


def predicted(cent: DataFrame, vals: DataFrame, pairs: DataFrame, entity: str, feature: str, k: int, n_all: int,
              chunk: int = BLOCK, own_rows: int | None = None, met_rows: int | None = None) -> DataFrame | None:
    """(entity, feature, _num, _den) of the distinct ``pairs``: sums of sim x v and of sim over the entity's ``k``
    neighbours that rated the feature, ``v`` from ``vals`` (entity, feature, v); pairs without such a neighbour are left
    out.  None as in :func:`nearest`.  No neighbour leaves a task, so what is written is a row a pair whatever ``k`` is."""
    kinds = [cent.schema[c].dataType for c in (entity, feature)]
    if any([df.schema[c].dataType for c in (entity, feature)] != kinds for df in (pairs, vals)):
        return None
    named = lambda df, *more: df.select(F.col(entity).alias("entity"), F.col(feature).alias("feature"), *more).where("entity IS NOT NULL AND feature IS NOT NULL")
    blocks = _blocks(cent, entity, feature, pairs.select(entity), chunk, own_rows or OWN_ROWS, met_rows or MET_ROWS, named(pairs), named(vals, "v"))
    if blocks is None:
        return None
    task = _predicted_met(k, n_all, *map(to_arrow_type, kinds))
    sums = blocks.run(task, f"entity {kinds[0].simpleString()}, feature {kinds[1].simpleString()}, num double, den double", "cf-sums")
    return sums.select(F.col("entity").alias(entity), F.col("feature").alias(feature), F.col("num").alias("_num"), F.col("den").alias("_den"))


def best(nb: DataFrame, cent: DataFrame, train: DataFrame, users: DataFrame, items: DataFrame, n: int, k: int,
         own_rows: int | None = None, met_rows: int | None = None) -> DataFrame | None:
    """(user_id, item_id, pred, den, rank): the ``n`` best unrated items of each of ``users`` (user_id, avg).

    Blocks of users meet what their neighbours rated, in rounds: a row leaves a task for each
    item of a list.  The first items by id, of which a user's list is filled up, come along
    in as many as a user can have taken.  None where a block would meet more than ``met_rows`` ratings.
    """
    kind, item_kind = train.schema["user_id"].dataType, train.schema["item_id"].dataType
    if any(df.schema[c].dataType != t for df, c, t in ((users, "user_id", kind), (items, "item_id", item_kind))):
        return None
    if not train.where("item_id IS NULL").isEmpty():
        return None
    users = users.where("user_id IS NOT NULL AND avg IS NOT NULL")
    n_near, n_users = nb.count(), users.count()
    n_blocks = -(-max(n_near, n_users) // (own_rows or OWN_ROWS)) or 1
    mine = lambda c: F.pmod(F.xxhash64(c), F.lit(n_blocks)).cast("int")
    rated = cent.where("item_id IS NOT NULL")
    degrees = rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    wants = written(nb.groupBy(F.col("b").alias("user_id")).agg(F.collect_set(mine("a")).alias("wants")).join(degrees, "user_id"), "cf-wants")
    met = wants.select(F.explode("wants").alias("i"), "n").groupBy("i").agg(F.sum("n").alias("met"))
    sent = met.agg(F.sum("met").alias("sent"), F.max("met").alias("met")).first()
    if (sent.met or 0) > (met_rows or MET_ROWS):
        drop_written(wants)
        return None
    most = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("all"), F.count(F.lit(1)).alias("users")).first()
    taken = min(items.count(), (k + 1) * (most["all"] or 0) + n)
    hot = degrees.agg(F.max("n")).first()[0] or 0
    nothing = lambda c, t: F.lit(None).cast(t).alias(c)
    lists = (_lists(rated, "user_id", "item_id", "c", hot).join(wants.select("user_id", "wants"), "user_id")
             .select(F.col("user_id").alias("met"), "entities", "cns", "wants", F.lit(False).alias("asked")))
    every = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    front = items.where("item_id IS NOT NULL").distinct().orderBy("item_id").limit(taken)
    front = (front.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(-(-taken // LIST_ROWS) or 1))).agg(F.collect_list("item_id").alias("entities"))
             .select(nothing("met", kind), "entities", F.array().cast("array<double>").alias("cns"), every.alias("wants"), F.lit(True).alias("asked")))
    lists = written(lists.unionByName(front), "cf-lists")
    seen = train.where("item_id IS NOT NULL").select("user_id", "item_id")
    own = (nb.select(mine("a").alias("i"), F.col("a").alias("entity"), F.col("b").alias("feature"), F.col("sim").alias("cn"), nothing("item", item_kind), F.lit(False).alias("asked"))
           .unionByName(seen.join(users.select("user_id"), "user_id", "left_semi")
                        .select(mine("user_id").alias("i"), F.col("user_id").alias("entity"), nothing("feature", kind), nothing("cn", "double"), F.col("item_id").alias("item"), F.lit(True).alias("asked")))
           .unionByName(users.select(mine("user_id").alias("i"), F.col("user_id").alias("entity"), nothing("feature", kind), F.col("avg").alias("cn"), nothing("item", item_kind), F.lit(True).alias("asked"))))
    drop_written(wants)
    task = _best_met(n, to_arrow_type(kind), to_arrow_type(item_kind))
    out = _Blocks(own, lists, n_blocks, (sent.sent or 0) + taken * n_blocks, cent.count()).run(
        task, f"entity {kind.simpleString()}, feature {item_kind.simpleString()}, pred double, den double, rank long", "cf-best")
    return out.select(F.col("entity").alias("user_id"), F.col("feature").alias("item_id"), "pred", "den", "rank")


def similarities(cent: DataFrame, entity: str, feature: str,
                 targets: DataFrame | None = None,
                 chunk: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """(a, b, sim) for every co-rated pair a != b with ``a`` in ``targets``.

    ``targets`` (one column named ``entity``) restricts the output to entities
    that need neighbours; ``chunk`` is the size of a block.  Pairs whose dot
    product is 0 still appear with sim 0.
    """
    groups, parts, kind = _dealt(cent, entity, feature, targets, chunk, task_rows)
    sums = groups.applyInArrow(_summed, f"a {kind}, b {kind}, sim double, ta boolean, tb boolean")
    if parts > 1:
        # the order of a pair is that of its blocks, the same in all parts
        sums = sums.groupBy("a", "b").agg(F.sum("sim").alias("sim"), F.max("ta").alias("ta"), F.max("tb").alias("tb"))
    both = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), F.col("ta").alias("k")),
                   F.struct(F.col("b").alias("x"), F.col("a").alias("y"), F.col("tb").alias("k")))
    return (sums.select(F.explode(both).alias("p"), "sim").where(F.col("p.k"))
            .select(F.col("p.x").alias("a"), F.col("p.y").alias("b"), "sim"))


def candidates(cent: DataFrame, entity: str, feature: str, k: int,
               targets: DataFrame | None = None, chunk: int = BLOCK, task_rows: int = TASK_ROWS,
               n_all: int | None = None, own_rows: int = OWN_ROWS, met_rows: int = MET_ROWS, by_feature: bool = True) -> DataFrame:
    """(a, b, sim, n): what :func:`top_k` needs of :func:`similarities` for ``k``.

    Rows with ``b`` null count the co-rated partners of ``a`` (their ``n`` add
    up); the others hold every partner that can rank among the first ``k``,
    from each pair of blocks.  ``n_all`` is the number of entities ranked.  Without
    ``by_feature`` pairs of blocks are met whatever the ratings.
    """
    met = _by_feature(cent, entity, feature, targets, k, chunk, n_all, own_rows, met_rows) if by_feature else None
    if met is not None:
        return met
    groups, parts, kind = _dealt(cent, entity, feature, targets, chunk, task_rows)
    if parts == 1:
        return groups.applyInArrow(_nearest(k), f"a {kind}, b {kind}, sim double, n long")
    # sums of parts are whole only after the shuffle; its window limits them map-side
    sims = similarities(cent, entity, feature, targets, chunk, task_rows)
    return sims.select("a", "b", "sim", F.lit(None).cast("long").alias("n")).unionByName(
        sims.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", F.lit(None).cast(kind).alias("b"), F.lit(None).cast("double").alias("sim"), "n"))


def top_k(sims: DataFrame, k: int, n_entities: Column | int, counts: DataFrame | None = None) -> DataFrame:
    """Neighbours of each ``a`` as a dense top-k over all other entities would pick.

    The dense ranking puts positives first, then every entity with
    similarity 0 (co-rated or not), then negatives.  One ordering of the
    co-rated pairs by (sign class: positive / zero / negative, then
    ``round(sim, 9) desc, b asc``) gives each pair its
    position ``rn``: a positive's dense rank is ``rn``; a negative's is
    ``(n_entities - 1) - n_co + rn`` with ``n_co`` the number of co-rated
    partners of ``a``.  Both are >= rn, so every kept row has ``rn <= k``:
    one ``row_number() <= k`` window (a per-partition limit before the
    shuffle, so a hot ``a`` is trimmed map-side) plus a partially aggregated
    count per ``a`` decide everything.  ``counts`` (a, _nco) gives the counts
    where ``sims`` lacks pairs that cannot rank.
    """
    n_all = n_entities if isinstance(n_entities, Column) else F.lit(n_entities)
    sign_class = F.when(F.col("sim") > 0, 0).when(F.col("sim") == 0, 1).otherwise(2)
    order = W.partitionBy("a").orderBy(sign_class, F.round("sim", 9).desc(), F.col("b").asc())
    head = (sims.withColumn("_rn", F.row_number().over(order))
            .where(F.col("_rn") <= k))
    n_co = sims.groupBy("a").agg(F.count(F.lit(1)).alias("_nco")) if counts is None else counts
    neg_rank = (n_all - 1) - F.col("_nco") + F.col("_rn")
    rank = F.when(F.col("sim") > 0, F.col("_rn")).when(F.col("sim") < 0, neg_rank)
    return (head.join(n_co, "a").withColumn("rank", rank)
            .where(F.col("rank") <= k).drop("_rn", "_nco"))
