"""Document quality rules kept as a bitmask ledger.

Method: every rule is evaluated once for a document and leaves one bit (set:
failed) in ``bits``, next to the measurements it used.  A policy is a named
version with a mask of the rules it enforces; a document is kept under it if
``bits & mask`` is zero, so policies are applied and changed without touching
the texts again.  Ablations come from the counts of distinct bit patterns,
which are at most ``2 ** len(RULES)`` whatever the size of the corpus.

All of it is DataFrame expressions on one row at a time: no shuffle, and no
group that could be hot.  Word windows are found repeated by sorting their
64-bit identifiers inside the row.

Defined cases: a null text has no words and no lines; equal texts get equal
rows; a text with fewer than three words has no word window; extra columns of
the input stay in :func:`ledger` and come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, let, table

SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: name -> condition that fails the rule, over the measurements; bit i belongs to rule i.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbol_share": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
}

#: Versions of what is enforced.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbol_share", "duplicate_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    """Bits of the named rules."""
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur at least twice in ``words``."""
    def covered(sorted_windows: Column) -> Column:
        def repeated(w: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(sorted_windows, i - 1)["h"])
            after = F.get(sorted_windows, i + 1)["h"]
            return F.coalesce(before == w["h"], F.lit(False)) | F.coalesce(after == w["h"], F.lit(False))

        places = F.array_sort(F.transform(F.filter(sorted_windows, repeated), lambda w: w["p"]))
        return let(places, lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1), p + 3) - p)),
            F.lit(0).cast("long"), lambda s, n: s + n))

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

        def judge(h: Column) -> Column:
            # most texts have no repeated window: told by a primitive sort-free distinct
            pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(pairs, covered))
        return let(hashes, judge)
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(windows(words))


def measures(text: Column) -> Column:
    """Struct of all measurements of a text."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: _without(x, SEPARATORS) != "")
        return let(F.struct(_words(t).alias("w"), lines.alias("l")), lambda s: F.struct(
            F.size(s["w"]).cast("long").alias("n_words"),
            F.length(_without(t, SEPARATORS)).cast("long").alias("word_chars"),
            (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
            F.size(s["l"]).cast("long").alias("n_lines"),
            (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(s["w"]).alias("n_repeat_words")))
    return let(text, of)


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with ``measures`` and ``bits`` (failed rules)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "measures", "bits")]
    measured = docs.select(*rest, measures(F.col("text")).alias("measures"))

    def bits(m: Column) -> Column:
        total = F.lit(0).cast("long")
        names = {n: m[n] for n in MEASURES}
        for i, condition in enumerate(_conditions(names)):
            total = total + F.when(condition, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        return total
    return measured.withColumn("bits", let(F.col("measures"), bits))


def _conditions(m: dict[str, Column]) -> list[Column]:
    """The conditions of ``RULES`` over given columns."""
    out = []
    for text in RULES.values():
        left, sign, right = text.split(" < ")[0], "<", text.split(" < ")[-1]
        if " > " in text:
            left, right = text.split(" > ")
            sign = ">"

        def side(s: str) -> Column:
            value = F.lit(1).cast("long")
            for part in s.split(" * "):
                value = value * (F.lit(int(part)).cast("long") if part.isdigit() else m[part])
            return value
        out.append(side(left) < side(right) if sign == "<" else side(left) > side(right))
    return out


def kept(bits: Column, policy: str = CURRENT) -> Column:
    """Whether a document passes a policy."""
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """(rule, n_failed, n_only): documents that fail a rule, and those that only it removes.

    ``n_only`` documents would be kept if the policy gave the rule up.  Counts
    come from the ledger's distinct bit patterns.
    """
    enforced = mask(POLICIES[policy])
    patterns = entries.groupBy(F.col("bits").bitwiseAND(F.lit(enforced).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    order = list(RULES)
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("long").alias("bit")) for r in POLICIES[policy]])
    return (patterns.select("bits", "n", F.explode(rules).alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only")))


OP9_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t),
dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
tri AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM tri),
cov AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE c > 1) GROUP BY r),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)),
b AS (SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
             + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
             + 16 * (word_chars < 3 * n_words)::BIGINT + 32 * (word_chars > 10 * n_words)::BIGINT) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits FROM b
"""


@REGISTRY("op9_quality_ledger", OP9_SQL)
def op9(spark, sf_dir):
    """Measurements, failed rules and verdict of every document."""
    entries = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select("doc_id", *[F.col("measures")[m].alias(m) for m in MEASURES if m != "n_lines"],
                          (~kept(F.col("bits"), "base")).alias("base_failed"), kept(F.col("bits")).alias("kept"), "bits")
