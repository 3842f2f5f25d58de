from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.operators import mapreduce as MR

PAGE = """<html><head><title>Some Movie (1999) - Site</title></head><body>
<span itemprop="genre">Drama</span><span itemprop="genre">War</span>
<span itemprop="director"><a href="/name/nm0000001/?ref">One Dir</a></span>
<span itemprop="director"><a href="/name/nm0000002/?ref">Two Dir</a></span>
<span itemprop="creator"><a href="/name/nm0000009/?ref">Wri Ter</a></span>
<span class="rating">8.1</span>
""" + "".join(f'<td itemprop="actor"><a href="/name/nm00001{n:02d}/"><span>Actor {n}</span></a></td>'
              for n in range(12)) + """
<h4>Country:</h4> <a href="/c">USA</a>
<h4>Release Date:</h4> 1 May 1999 (USA)
<h4>Color:</h4> <a href="/col">Color</a>
<a id="follows" name="follows"></a><a href="/title/tt0000011/">Prequel</a> (1990)
<a href="/title/tt0000012/">Other</a> (TV (1991))
<p class="plotSummary">A story
about war &amp; peace.</p></body></html>"""
EMPTY = "<html><head><title>Bare</title></head><body><p>x</p></body></html>"


def test_movie_record_fields(spark):
    df = spark.createDataFrame([(1, PAGE), (2, EMPTY)], "page_id long, html string")
    recs = {r.page_id: r.r for r in df.select("page_id", H.movie_record("html").alias("r")).collect()}
    r = recs[1]
    assert r.title == "Some Movie "
    assert r.genres == ["Drama", "War"]
    assert r.directors == ["nm0000001", "nm0000002"] and r.dir_name == ["One Dir", "Two Dir"]
    assert r.writer == "nm0000009" and r.writer_name == "Wri Ter"
    assert r.rating == "8.1" and len(r.actors) == 10 and r.actor_names[0] == "Actor 0"
    assert r.country == "USA" and r.color == "Color" and r.release_date == "1 May 1999"
    assert r.related_movies == ["tt0000011/"]            # href[7:]; "(TV (1991))" has two
    assert r.synopsis == "A story \n about war & peace."
    e = recs[2]
    assert e.directors == [] and e.writer == "" and e.rating == "NA" and e.related_movies == []


def test_a_container_without_a_link_takes_no_later_link(spark):
    page = ('<title>Am&eacute;lie (x)</title><span itemprop="director">Unlinked</span>'
            '<span itemprop="creator">None</span><span itemprop="creator"><a href="/name/nm0000009/">W</a></span>'
            '<td itemprop="actor">-</td><td itemprop="actor"><a href="/name/nm0000003/"><span>O&#39;N</span></a></td>'
            '<span itemprop="genre">Sci &amp; Fi</span>')
    r = spark.createDataFrame([(page,)], "html string").select(H.movie_record("html").alias("r")).first().r
    assert r.title == "Am\u00e9lie " and r.genres == ["Sci & Fi"]
    assert r.directors == [] and r.dir_name == [] and r.writer == "" and r.writer_name == ""
    assert r.actors == ["nm0000003"] and r.actor_names == ["O'N"]


def test_character_references_like_the_standard_library(spark):
    import html
    texts = ["&lt;&#x41;&#66;&euro;&amp;lt;", "no reference", "", "& &nosuch; &#0; &#xD800; a&b;c", "&copy;&middot;&hearts;",
             "&#128512;!"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [r[0] for r in df.select(H.unescape("t")).collect()]
    assert got == [html.unescape(t) if "nosuch" not in t else t for t in texts] + [None]


def test_pairs_without_key_or_value_are_dropped(spark):
    def mapper(b):
        return b.rename(columns={"value": "key"}).assign(value=[None if k == "x" else 1 for k in b["value"]])
    df = spark.createDataFrame([("a",), (None,), ("x",), ("a",)], "value string")
    out = MR.map_reduce(df, mapper, MR.sum_reducer, 2, "key string, value long")
    assert [(r.key, r.value) for r in out.collect()] == [("a", 2)]


def test_generic_map_reduce_equals_builtin(spark):
    lines = spark.createDataFrame([("the cat the hat",), ("The end",), ("",), ("cat cat",)] * 5,
                                  "value string")
    a = {r.key: r.value for r in MR.word_count(lines, n_reducers=3).collect()}
    b = {r.key: r.value for r in MR.word_count_builtin(lines).collect()}
    assert a == b and a["the"] == 15 and a["cat"] == 15


def test_map_reduce_without_combiner_streams_groups(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("value"))

    def mapper(b):
        return b.rename(columns={"value": "key"}).assign(value=1)

    def reducer(k, vals):
        yield (k, sum(vals))
    out = MR.map_reduce(df, mapper, reducer, 2, "key string, value long")
    assert sorted((r.key, r.value) for r in out.collect()) == [("0", 334), ("1", 333), ("2", 333)]


def test_piped_pairs_are_summed_before_the_shuffle(spark):
    """A combiner next to the mapper gives the same sums from fewer pairs, and its mapper's failure is one."""
    import pytest
    from tessera.plans import io_queries as IO
    lines = spark.createDataFrame([(" a b\ta  a",), ("b\n\u00e9 a",), (None,), ("",)] * 50, "text string").coalesce(2)
    assert MR.through_program(lines, f"{IO.AWK_WORDS} | {IO.AWK_COMBINED}").count() <= 6
    for combiner in (None, IO.AWK_COMBINED, IO.AWK_COMBINED.replace("100000", "2")):
        out = MR.key_values(MR.piped(lines, IO.AWK_WORDS, IO.AWK_SUMS, 3, combiner=combiner)).collect()
        assert sorted((r.key, r.value) for r in out) == [("a", "200"), ("b", "100"), ("\u00e9", "50")]
    with pytest.raises(Exception):
        MR.piped(lines, "cat; exit 3", IO.AWK_SUMS, 3, combiner="cat").count()
