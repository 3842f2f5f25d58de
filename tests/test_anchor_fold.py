"""HTM-9 in Catalyst against a walk with the standard library's parser; term join and programs."""

import itertools
import random
from html.parser import HTMLParser

from conftest import SF001
from tessera.functions import html as H
from tessera.operators import mapreduce as MR, weighting as WT


class Walk(HTMLParser):
    """Anchors in order, each with the first text behind it."""

    def __init__(self):
        super().__init__()
        self.anchors, self.state = [], None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.anchors.append({"href": dict(attrs).get("href"), "id": dict(attrs).get("id"), "after": None})
            self.state = "in"
        elif self.state == "after":
            self.state = None

    def handle_endtag(self, tag):
        if tag == "a" and self.state == "in":
            self.state = "after"

    def handle_data(self, data):
        if self.state == "after":
            self.anchors[-1]["after"], self.state = data, None


def related(page):
    walk = Walk()
    walk.feed(page or "")
    walk.close()
    ids, out = [a["id"] for a in walk.anchors], []
    for start in ("follows", "followed_by"):
        if start in ids:
            rest = walk.anchors[ids.index(start) + 1:]
            kept = itertools.takewhile(lambda a: a["href"] is not None and a["after"] is not None, rest)
            out += [a["href"][7:] for a in kept if a["after"][1:].count("(") == 1]
    return out


def test_related_movies_equal_a_parser_walk(spark):
    bits = ['<a id="follows" name="f"></a>', "<a id='followed_by'></a> x", '<A HREF="/title/tt1/">M</A> (1990)',
            "<a class=x href='/title/tt2/?a&amp;b'><b>N</b></a> (TV (1))", '<a href=/title/tt3/>O</a></i> (1991)',
            '<a href="/title/tt4/">P</a><br> (1)', '<a name="q">Q</a> (2)', "<script>'<a href=\"/title/tt9/\">z</a> (3)'</script>",
            '<a href="/title/tt5/">R</a> &#40;5)', "<abbr>(</abbr>", '<!-- <a id="follows"></a> -->', "<p>text (", "<a id=follows />", '<a href="/title/tt6/">S</a> (6)']
    rng = random.Random(5)
    pages = ["".join(rng.choices(bits, k=rng.randrange(14))) + "</body>" for _ in range(400)] + ["", None, "no anchors", bits[0]]
    got = spark.createDataFrame(list(enumerate(pages)), "i long, html string").select("i", H.related_movies("html").alias("r"))
    assert {r.i: r.r for r in got.collect()} == {i: related(p) for i, p in enumerate(pages)}
    assert sum(bool(related(p)) for p in pages) > 50
    assert "Python" not in got._jdf.queryExecution().toString()


def test_frequent_terms_by_broadcast_equal_one_join(spark):
    rows = [(i, f"t{i % 7}", f"common {'rare%d ' % i * (i % 4)} half{i % 2}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string")
    every = [sorted((r.doc_id, r.term, round(r.weight, 12)) for r in WT.boosted_tfidf(docs, hot_terms=n).collect()) for n in (1, 4, 10 ** 6)]
    assert every[0] == every[1] == every[2] and sum(t == "common" for _, t, _ in every[0]) == 60


def test_programs_drop_lines_that_are_no_pairs(spark):
    lines = spark.createDataFrame([("b a\nb",), (None,), ("",), ("10 010 1e1",)], "value string").repartition(3)
    mapper = """awk '{ print "no pair"; print "a\\tb\\tc"; for (i = 1; i <= NF; i++) print $i "\\t" 2 }'"""
    assert sorted(r.line for r in MR.piped(lines, mapper, "cat", 3).collect()) == ["010\t2", "10\t2", "1e1\t2", "a\t2", "b\t2", "b\t2"]
    from tessera.plans.catalog import _io
    AWK_SUMS = _io.AWK_SUMS
    assert sorted(r.line for r in MR.piped(lines, mapper, AWK_SUMS, 2).collect()) == ["010\t2", "10\t2", "1e1\t2", "a\t2", "b\t4"]
    assert MR.piped(lines.where("false"), mapper, AWK_SUMS, 2).count() == 0
