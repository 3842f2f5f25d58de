"""Field extraction from stored movie pages (HTM-1..10) and generic page text.

Everything is a built-in expression (JVM side).  HTM-9, which follows anchors
in document order and looks at the text after each one, works on an array of
anchor structs.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_ACTORS = 10
MAX_DIRECTORS = 2


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unescape(c) -> Column:
    """Text with its character references decoded, in one pass over the text.

    Decodes references that end in ``;``: decimal, hexadecimal, and the names of
    the standard library's HTML 4 table (and ``apos``).  Others stay as they are.
    """
    names = F.str_to_map(F.lit(",".join(f"{n}:{cp}" for n, cp in sorted(name2codepoint.items())) + ",apos:39"),
                         F.lit(","), F.lit(":"))

    def after_ampersand(p):
        ref = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});", 1)
        code = (F.when(ref.rlike("^#[xX]"), F.conv(F.substr(ref, F.lit(3)), 16, 10).try_cast("int"))
                .when(ref.startswith("#"), F.substr(ref, F.lit(2)).try_cast("int"))
                .otherwise(F.try_element_at(names, ref).try_cast("int")))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF),
                       F.concat(char, F.substr(p, F.length(ref) + F.lit(2))))
                .otherwise(F.concat(F.lit("&"), p)))

    parts = F.split(_col(c), "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), after_ampersand)
    return F.concat(F.try_element_at(parts, F.lit(1)), F.array_join(rest, ""))


def title(html="html") -> Column:
    """HTM-1: text of <title> before the first '('."""
    t = F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.split(unescape(t), r"\(", -1)[0]


def links(html="html") -> Column:
    """All anchor targets, in page order."""
    return F.regexp_extract_all(_col(html), F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), 1)


def visible_text(html="html") -> Column:
    """Page text: scripts, styles and comments removed, tags dropped, entities
    decoded, whitespace collapsed."""
    h = _col(html)
    h = F.regexp_replace(h, r"(?is)<script\b.*?</script>", " ")
    h = F.regexp_replace(h, r"(?is)<style\b.*?</style>", " ")
    h = F.regexp_replace(h, r"(?s)<!--.*?-->", " ")
    h = F.regexp_replace(h, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(unescape(h), r"\s+", " "))


def _itemprop_links(html: Column, tag: str, prop: str, n: int) -> Column:
    """(href, name) of the first link inside each of the first ``n`` ``<tag itemprop=prop>``.

    A container ends at the first closing tag of its kind, so a link behind it
    never counts; a container without a link gives a null href.
    """
    body = F.regexp_extract_all(
        html, F.lit(rf'(?is)<{tag}\b[^>]*itemprop="{prop}"[^>]*>(.*?)</{tag}>'), 1)
    link = r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>\s*(?:<span[^>]*>)?([^<]*)'
    return F.transform(F.slice(body, 1, n), lambda x: F.struct(
        F.when(x.rlike(link), F.regexp_extract(x, link, 1)).alias("href"),
        unescape(F.regexp_extract(x, link, 2)).alias("name")))


def _after_heading(html: Column, heading: str, link: bool) -> Column:
    if link:
        pat = rf"(?is)<h4[^>]*>\s*{heading}\s*</h4>.*?<a[^>]*>([^<]*)</a>"
    else:
        pat = rf"(?is)<h4[^>]*>\s*{heading}\s*</h4>([^<]*)"
    return unescape(F.regexp_extract(html, pat, 1))


def _py_slice(s: Column, start: int, stop: int | None) -> Column:
    """Python ``s[start:stop]`` for non-negative start and negative/None stop."""
    n = F.length(s)
    end = n if stop is None else n + F.lit(stop)
    return F.when(end > start, F.substr(s, F.lit(start + 1), end - start)).otherwise(F.lit(""))


def _once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or not; null where the tag has none."""
    pat = rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pat, g) for g in (1, 2, 3)])
    return F.when(tag.rlike(pat), unescape(value))


def _anchor(part: Column) -> Column:
    """(href, id, after) of the anchor whose page part starts behind ``<a``.

    ``after`` is the first text behind the anchor, where no tag opens before it.
    """
    tag = F.regexp_extract(part, r"""^((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", 1)
    closed = tag.endswith("/") & ~tag.rlike(r"""=\s*[^\s"'>]+$""")   # the slash is no part of a bare value
    behind = F.when(closed, F.substr(part, F.length(tag) + 2)).otherwise(
        F.try_element_at(F.split(part, r"(?i)</a\s*>", 2), F.lit(2)))
    text = F.regexp_extract(behind, r"^(?:</[a-zA-Z][^>]*>)*([^<]+)", 1)
    return F.struct(_attribute(tag, "href").alias("href"), _attribute(tag, "id").alias("id"),
                    F.when(text != "", unescape(text)).alias("after"))


def _followers(anchors: Column, start: str) -> Column:
    """Targets behind the first anchor named ``start``, up to one without a target or a text behind it."""
    at = F.array_position(F.transform(anchors, lambda a: F.coalesce(a["id"], F.lit(""))), start).cast("int")

    def until_stop(rest):
        stop = F.array_position(F.transform(rest, lambda a: a["href"].isNull() | a["after"].isNull()), True).cast("int")
        return F.slice(rest, F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size(rest)))

    rest = F.slice(anchors, at + 1, F.when(at > 0, F.size(anchors)).otherwise(F.lit(0)))
    one = F.filter(_once(rest, until_stop), lambda a: F.size(F.split(F.substr(a["after"], F.lit(2)), r"\(", -1)) == 2)
    return F.transform(one, lambda a: F.substr(a["href"], F.lit(8)))


def related_movies(html="html") -> Column:
    """HTM-9: ids (href[7:]) of the links after the ``follows`` / ``followed_by``
    anchors whose trailing text holds exactly one '('.

    Only pages that name one of the two are taken apart; others, and null pages,
    give an empty array.
    """
    h = _col(html)
    shown = F.regexp_replace(h, r"(?s)<!--.*?-->", "")
    shown = F.regexp_replace(shown, r"(?is)(<(script|style)\b[^>]*>).*?</\2\s*>", "$1</$2>")
    parts = F.split(shown, r"(?i)<a(?=[\s>/])", -1)
    anchors = F.transform(F.slice(parts, F.lit(2), F.size(parts)), _anchor)
    found = _once(anchors, lambda a: F.concat(_followers(a, "follows"), _followers(a, "followed_by")))
    named = h.rlike(r"""(?i)\bid\s*=\s*["']?(?:follows|followed_by)\b""")
    return F.when(named, found).otherwise(F.array().cast("array<string>"))


def plot_summary(html="html") -> Column:
    """HTM-10: text of ``p.plotSummary`` with newlines padded to ' \\n '."""
    t = F.regexp_extract(_col(html), r'(?is)<p[^>]*class="plotSummary"[^>]*>(.*?)</p>', 1)
    return F.replace(unescape(t), F.lit("\n"), F.lit(" \n "))


def movie_record(html="html") -> Column:
    """HTM-1..10 as one struct (synopsis before stop-word stripping)."""
    h = _col(html)
    dirs = _itemprop_links(h, "span", "director", MAX_DIRECTORS)
    first = F.try_element_at(dirs, F.lit(1))
    # no director at all where the first one has no link
    dirs = F.filter(dirs, lambda x: first["href"].isNotNull() & x["href"].isNotNull())
    writer = F.try_element_at(_itemprop_links(h, "span", "creator", 1), F.lit(1))
    actors = F.filter(_itemprop_links(h, "td", "actor", MAX_ACTORS), lambda x: x["href"].isNotNull())
    rating = F.regexp_extract(h, r'(?is)<span[^>]*class="rating"[^>]*>([^<]*)', 1)
    release = F.split(_after_heading(h, "Release Date:", False), r"\(", -1)[0]
    return F.struct(
        title(h).alias("title"),
        F.transform(F.regexp_extract_all(
            h, F.lit(r'(?is)<span[^>]*itemprop="genre"[^>]*>([^<]*)</span>'), 1), unescape).alias("genres"),
        F.transform(dirs, lambda x: F.substr(x["href"], F.lit(7), F.lit(9))).alias("directors"),
        F.transform(dirs, lambda x: x["name"]).alias("dir_name"),
        F.coalesce(F.substr(writer["href"], F.lit(7), F.lit(9)), F.lit("")).alias("writer"),
        F.when(writer["href"].isNotNull(), writer["name"]).otherwise("").alias("writer_name"),
        F.when(rating == "", F.lit("NA")).otherwise(rating).alias("rating"),
        F.transform(actors, lambda x: F.substr(x["href"], F.lit(7), F.lit(9))).alias("actors"),
        F.transform(actors, lambda x: x["name"]).alias("actor_names"),
        _after_heading(h, "Country:", True).alias("country"),
        _py_slice(release, 1, -1).alias("release_date"),
        _py_slice(_after_heading(h, "Gross:", False), 8, -16).alias("gross"),
        _after_heading(h, "Color:", True).alias("color"),
        related_movies(h).alias("related_movies"),
        plot_summary(h).alias("synopsis"))
