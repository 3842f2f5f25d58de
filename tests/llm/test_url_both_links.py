"""A page that names a canonical address and redirects as well."""

from tessera.llm import url_filter as U


def test_both_links_are_edges(spark):
    html = '<html><link rel="canonical" href="{}"><meta http-equiv="refresh" content="0; url={}"></html>'
    pages = [(1, "http://a.org/x", html.format("http://a.org/x", "http://b.net/es/1")),  # its own canonical address, moved to a blocked one
             (2, "http://c.org/y", html.format("http://d.org/z", "http://b.net/fr/1")),
             (3, "http://d.org/z", ""), (4, "http://e.org/w", "")]
    out = U.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), U.rule_table(spark)).collect()
    assert {r.page_id: (r.verdict, r.alias) for r in out} == {1: ("block", True), 2: ("block", True), 3: ("block", True), 4: ("allow", False)}
