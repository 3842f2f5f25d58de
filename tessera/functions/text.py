"""Text column expressions: tokenizer, people strings, highlighting, snippets.

All are built-in Spark expressions (JVM side, inside whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Word tokenizer: maximal runs of Unicode letters, digits and underscore (the
# Unicode meaning of \w; Java's own \w is ASCII-only).
TOKEN_PATTERN = r"([\p{L}\p{N}_]+)"
# Highlight markup, person-list separator and snippet geometry.
HIGHLIGHT_OPEN = "<strong>"
HIGHLIGHT_CLOSE = "</strong>"
PERSON_SEP = " ; "
SNIPPET_LEAD = 50
SNIPPET_LEN = 400
SNIPPET_PREFIX = "... "
SNIPPET_SUFFIX = " ..."


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(c) -> Column:
    """TXT-1: array of word tokens (case kept; lower-case first if needed)."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN_PATTERN), 1)


def people_text(actors="actors", directors="directors", writer="writer") -> Column:
    """TXT-3 (index form): actors, directors and writer joined by spaces."""
    return F.concat_ws(" ", F.array_join(_col(actors), " "),
                       F.array_join(_col(directors), " "), F.coalesce(_col(writer), F.lit("")))


def person_list(names) -> Column:
    """TXT-3 (store form): every name followed by ' ; '."""
    return F.array_join(F.transform(_col(names), lambda x: F.concat(x, F.lit(PERSON_SEP))), "")


def _alternation(terms) -> Column:
    """Literal, case-insensitive alternation of the non-empty terms.

    A ``\\E`` inside a term would end the quotation, so it is quoted apart.
    """
    quoted = F.transform(F.filter(_col(terms), lambda t: F.length(t) > 0),
                         lambda t: F.concat(F.lit(r"\Q"), F.replace(t, F.lit(r"\E"), F.lit(r"\E\\E\Q")),
                                            F.lit(r"\E")))
    return F.concat(F.lit("(?iu)("), F.array_join(quoted, "|"), F.lit(")"))


def any_term_in(text, terms) -> Column:
    """FLT-5: some non-empty term occurs in ``text`` (case-insensitive substring)."""
    low = F.lower(_col(text))
    return F.exists(_col(terms), lambda t: (F.length(t) > 0) & (F.instr(low, F.lower(t)) > 0))


def highlight(text, terms) -> Column:
    """TXT-17: wrap every case-insensitive literal match of any term in <strong>.

    One alternation regex over all terms (leftmost match, first term wins),
    no neighbouring characters consumed, no re-scan of inserted markup.
    """
    t = _col(text)
    has_terms = F.exists(_col(terms), lambda x: F.length(x) > 0)
    return F.when(has_terms, F.regexp_replace(
        t, _alternation(terms), F.lit(f"{HIGHLIGHT_OPEN}$1{HIGHLIGHT_CLOSE}"))).otherwise(t)


def _next_space(h: Column, start0: Column) -> Column:
    """0-based index of the first space at or after 0-based ``start0``; -1 if none."""
    return F.call_function("locate", F.lit(" "), h, start0 + 1) - 1


def snippet(h) -> Column:
    """TXT-18: keyword-in-context window of highlighted text ``h``.

    start = 50 characters before the character preceding the first match
    (0 if that is within the first 50), moved forward to the next space and
    prefixed with '... '; then 400 characters, extended to the next space and
    suffixed with ' ...' when text remains (no further space: the rest of the
    text).  Positions are counted on the highlighted text.
    """
    h = _col(h)
    first = F.instr(h, HIGHLIGHT_OPEN) - 1                        # 0-based, -1 if none
    begin = F.when(first > 0, first - 1).otherwise(F.lit(0))
    s0 = F.when(begin > SNIPPET_LEAD, begin - SNIPPET_LEAD).otherwise(F.lit(0))
    sp = _next_space(h, s0)
    start = F.when(s0 == 0, F.lit(0)).when(sp >= 0, sp).otherwise(F.length(h))
    prefix = F.when(s0 > 0, F.lit(SNIPPET_PREFIX)).otherwise(F.lit(""))
    long = F.length(h) > start + SNIPPET_LEN
    end = _next_space(h, start + SNIPPET_LEN)
    body = (F.when(long & (end >= 0), F.substr(h, start + 1, end - start))
            .otherwise(F.substr(h, start + 1)))
    suffix = F.when(long, F.lit(SNIPPET_SUFFIX)).otherwise(F.lit(""))
    return F.concat(prefix, body, suffix)


def leading_snippet(text) -> Column:
    """TXT-19: the text if shorter than 400 characters, else the first 400
    extended to the next space plus ' ...' (the whole text if no space)."""
    t = _col(text)
    end = _next_space(t, F.lit(SNIPPET_LEN))
    return (F.when(F.length(t) < SNIPPET_LEN, t)
            .when(end >= 0, F.concat(F.substr(t, F.lit(1), end), F.lit(SNIPPET_SUFFIX)))
            .otherwise(F.concat(t, F.when(F.length(t) > SNIPPET_LEN, F.lit(SNIPPET_SUFFIX))
                                .otherwise(F.lit("")))))
