"""Documents that hold benchmark items, also with other numbers, names or units.

Method: texts become templates.  A token is a number, a name (a word that
begins with one capital but no sentence), a unit (a unit word after a number) or a
literal (a lower-cased word); the first three stand as typed placeholders.
Windows of ``WINDOW`` template tokens are hash-joined between documents and
items.  Windows that match along one alignment of a document and an item are
put together; if they cover ``MIN_COVERED`` of the item's tokens, their slots
are compared: a value of the item that has several values in the document drops
the windows that hold it, and the others must still cover as much.  Benchmark windows with fewer than
``MIN_LITERALS`` literals say too little; the query and the pipeline match them
word for word instead (``literal``), and items shorter than ``WINDOW`` as a whole.

All of it is DataFrame expressions.  The item side is broadcast if its windows
number at most ``BROADCAST_WINDOWS``, else it is an ordinary shuffle join; the
documents send only matches, by row key, and only documents with enough of
them are read again for their slots.

Defined cases: null and empty texts match nothing; items shorter than
``MIN_COVERED`` tokens are matched only as a whole, and items shorter than
``WINDOW`` only with ``literal``, wherever their words stand in a row; a passage the item itself repeats counts once; repeated
documents or items each give their rows; null ids are kept; empty tables give
an empty result; extra columns stay in :func:`keep_uncontaminated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, let, saved, table

WINDOW = 8
MIN_COVERED = 12
MIN_LITERALS = 4
BROADCAST_WINDOWS = 500_000

NAME = "\uE001"
NUMBER_RE = "[$€£]?\\p{Nd}+(?:[.,:/]\\p{Nd}+)*%?"
UNITS = """km cm mm m kg g mg lb lbs oz l ml mile miles meter meters metre metres gram grams kilogram kilograms
liter liters litre litres inch inches foot feet yard yards acre acres hour hours minute minutes second seconds
day days week weeks month months year years dollar dollars euro euros cent cents pound pounds percent degree
degrees mph kmh""".split()


def tokens(text: Column) -> Column:
    """Tokens of a text: numbers, words, and names behind a mark."""
    plain = F.translate(F.coalesce(text, F.lit("")), NAME, "")
    marked = F.regexp_replace(plain, "\\p{Lu}(?<=[\\p{L}\\p{Nd},;][\\x20\\x09-\\x0D]\\p{Lu})\\p{Ll}\\p{L}*", NAME + "$0")
    return F.regexp_extract_all(marked, F.lit(f"{NUMBER_RE}|{NAME}?\\p{{L}}[\\p{{L}}\\p{{M}}]*"), F.lit(0))


def _is_number(token: Column) -> Column:
    # the first character tells most words apart before a pattern is tried
    return (F.ascii(token) < 0x61) & token.rlike("^[$€£]?\\p{Nd}") | (F.ascii(token) > 0x7A) & token.rlike("^[€£]?\\p{Nd}")


def template(toks: Column) -> Column:
    """The tokens with placeholders for typed slots (``#``, ``@``, ``~``), literals in lower case."""
    def one(t: Column, i: Column) -> Column:
        unit = F.lower(t).isin(UNITS) & F.coalesce(_is_number(F.get(toks, i - 1)), F.lit(False))
        return F.when(t.startswith(NAME), "@").when(_is_number(t), "#").when(unit, "~").otherwise(F.lower(t))
    return F.transform(toks, one)


def windows(text: Column, width: int = WINDOW) -> Column:
    """Array of (p, h): hash of the template window at each token."""
    def of(hashes: Column) -> Column:
        return F.when(F.size(hashes) >= width, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))
        ).otherwise(F.array().cast("array<bigint>"))
    return let(tokens(text), lambda t: let(F.transform(template(t), lambda x: F.xxhash64(x)), of))


def _items(benchmark: DataFrame, width: int, min_literals: int) -> tuple[DataFrame, DataFrame]:
    """The benchmark's rows (item, item_id, toks, slots) and their windows (item, p, h)."""
    rows = benchmark.select("item_id", F.xxhash64(F.col("item_id").cast("string"), "text").alias("item"),
                            tokens(F.col("text")).alias("toks")).dropDuplicates(["item"])
    rows = saved(rows.withColumn("slots", template(F.col("toks"))), "op2-items")
    at = F.posexplode(F.when(F.size("slots") >= width, F.expr(
        f"transform(sequence(0, size(slots) - {width}), i -> slice(slots, i + 1, {width}))")))
    wide = rows.select("item", at.alias("p", "w"))
    literals = F.size(F.filter("w", lambda x: ~x.isin("#", "@", "~")))
    hashes = F.xxhash64(*[F.xxhash64(F.get("w", F.lit(k))) for k in range(width)])
    return rows, saved(wide.where(literals >= min_literals).select("item", "p", hashes.alias("h")), "op2-windows")


def _plain(toks: Column) -> Column:
    return F.transform(toks, lambda t: F.lower(F.translate(t, NAME, "")))


def _literal_items(items: DataFrame, width: int, min_literals: int) -> DataFrame:
    """(item, p, n, h): the untyped windows of ``n`` tokens that templates leave out; short items whole."""
    n = f"least({width}, size(slots))"
    each = F.expr(f"transform(sequence(0, size(slots) - {n}), i -> named_struct("
                  f"'w', slice(slots, i + 1, {n}), 'l', slice(plain, i + 1, {n})))")
    wide = (items.where(F.size("slots") > 0).withColumn("plain", _plain(F.col("toks")))
            .select("item", F.size("slots").alias("size"), F.posexplode(each).alias("p", "x")))
    literals = F.size(F.filter("x.w", lambda x: ~x.isin("#", "@", "~")))
    return saved(wide.where((F.col("size") < width) | (literals < min_literals))
                 .select("item", "p", F.size("x.l").alias("n"), F.xxhash64("x.l").alias("h")), "op2-literal-windows")


def _literal_windows(text: Column, sizes: list[int]) -> Column:
    """Array of (n, at, h): hashes of the untyped windows of each of ``sizes`` tokens."""
    def of(t: Column, n: int) -> Column:
        at = F.when(F.size(t) >= n, F.sequence(F.lit(0), F.size(t) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(F.lit(n).alias("n"), i.alias("at"), F.xxhash64(F.slice(t, i + 1, n)).alias("h")))
    return let(_plain(tokens(text)), lambda t: F.flatten(F.array(*[of(t, n) for n in sizes])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, min_covered: int = MIN_COVERED,
               min_literals: int = MIN_LITERALS, literal: bool = False) -> DataFrame:
    """(rid, doc_id, item_id, n_covered, n_tokens, n_slots, reworded) of each document and item it holds.

    ``rid`` keys a document's row by its content, ``reworded`` tells that a
    slot's value differs from the item's.  With ``literal``, what templates
    leave out is matched word for word: windows of few literals, and items
    shorter than ``width`` as a whole.
    """
    items, known = _items(benchmark, width, min_literals)
    known = F.broadcast(known) if known.count() <= BROADCAST_WINDOWS else known
    rid = F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid")
    wide = docs.select(rid, F.posexplode(windows(F.col("text"), width)).alias("at", "h"))
    met = wide.join(known, "h").select("rid", "item", "at", "p")
    exact = _literal_items(items, width, min_literals) if literal else None
    sizes = sorted(r.n for r in exact.select("n").distinct().collect()) if literal else []
    if sizes:  # else templates leave nothing out
        exact = F.broadcast(exact) if exact.count() <= BROADCAST_WINDOWS else exact
        words = docs.select(rid, F.explode(_literal_windows(F.col("text"), sizes)).alias("x")).select("rid", "x.*")
        met = met.unionByName(words.join(exact, ["n", "h"]).select("rid", "item", "at", "p"))
    hits = met.groupBy("rid", "item", (F.col("at") - F.col("p")).alias("shift")).agg(F.collect_set("p").alias("ps"))
    span = f"least({width}, n_tokens)"
    covered = F.expr(f"aggregate(transform(array_sort(ps), (p, i) -> least({span}, coalesce(get(array_sort(ps), i + 1), p + {span}) - p)), "
                     "0L, (s, n) -> s + n)")
    enough = (saved(hits, "op2-hits").join(items.select("item", F.size("slots").alias("n_tokens")), "item")
              .withColumn("n_covered", covered)
              .where(F.col("n_covered") >= F.least(F.lit(min_covered), "n_tokens")))
    some = enough.groupBy("rid").agg(F.collect_list(F.struct("item", "shift", "ps", "n_covered", "n_tokens")).alias("found"))
    again = (docs.select("doc_id", "text", rid).join(some.hint("shuffle_hash"), "rid")
             .select("rid", "doc_id", let(tokens(F.col("text")), _plain).alias("have"), "found")
             .select("rid", "doc_id", "have", F.explode("found").alias("f")).select("rid", "doc_id", "have", "f.*")
             .join(items.withColumn("plain", _plain(F.col("toks"))), "item"))
    is_slot = lambda p: F.get("slots", p).isin("#", "@", "~")
    places = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.sequence(p, p + F.least(F.lit(width), "n_tokens") - 1))))
    pairs = F.array_distinct(F.transform(F.filter(places, is_slot), lambda p: F.struct(
        F.get("plain", p).alias("a"), F.get("have", p + F.col("shift")).alias("b"))))
    # a value of the item that has several in the document takes its windows with it
    torn = F.filter(F.transform("pairs", lambda x: x["a"]), lambda a: F.size(F.filter("pairs", lambda x: x["a"] == a)) > 1)
    whole = F.filter("ps", lambda p: ~F.exists(F.sequence(p, p + F.least(F.lit(width), "n_tokens") - 1), lambda q: is_slot(q) & F.array_contains(
        "torn", F.get("plain", q))))
    judged = (again.withColumn("pairs", pairs).withColumn("torn", torn).withColumn("ps", whole).withColumn("n_covered", covered)
              .where(F.col("n_covered") >= F.least(F.lit(min_covered), F.size("slots"))).withColumn("pairs", pairs))
    return (judged.select("rid", "doc_id", "item", "item_id", "n_covered", "n_tokens", F.size("pairs").alias("n_slots"),
                    F.exists("pairs", lambda x: x["a"] != x["b"]).alias("reworded"))
            .groupBy("rid", "doc_id", "item", "item_id", "n_tokens")
            .agg(F.max("n_covered").alias("n_covered"), F.max("n_slots").alias("n_slots"), F.min("reworded").alias("reworded"))
            .drop("item"))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, literal: bool = False) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    leaks = find_leaks(docs, benchmark, literal=literal).select("rid").distinct()
    # the row travels in a struct, so its columns may have any name
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(row.alias("doc"), F.xxhash64(F.col("doc_id").cast("string"), F.col("text")).alias("rid"))
    clean = packed.join(leaks.hint("shuffle_hash"), "rid", "left_anti")
    return clean.select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])


@REGISTRY("op2_template_decontamination")
def op2(spark, sf_dir):
    """Documents that hold items of `benchmark`, with the item and how much of it."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), literal=True)
    return found.select("doc_id", "item_id", "n_covered", "n_tokens", "n_slots", "reworded")
