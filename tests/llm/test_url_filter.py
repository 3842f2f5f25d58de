import re

from tessera.llm import url_filter as U

LINK = '<html><link href="{}" rel="canonical"></html>'
REFRESH = "<META HTTP-EQUIV=refresh CONTENT='0; URL={}'>"
PAGES = [
    (1, "http://a.org/x", LINK.format("https://b.example.net/es/1")),      # alias of a blocked page
    (2, "https://B.example.net/es/1?q=1#f", None),                         # blocked
    (3, "http://c.org/y", REFRESH.format("http://a.org/x")),               # two steps away
    (4, "http://d.org/z", LINK.format("http://www.example.com/en/9")),     # alias of an allowed page
    (5, "http://e.net/fr/1", LINK.format("http://www.example.com/en/9")),  # own rule wins
    (6, "http://f.org/", LINK.format("/other")),                           # relative, no rule
    (7, "http://f.org/other", "no link"),
    (8, "http://h.org/q", '<link rel=canonical href=http://k.net/fr/x>'),
    (9, "http://i.org/q", LINK.format("http://k.net/fr/x")),               # with 8, but i.org links on to an allowed page
    (9, "http://i.org/q", LINK.format("http://z.com/a")),
    (10, None, LINK.format("http://k.net/fr/x")),
    (11, "no scheme", "x"),
    (None, "http://example.com/en/", ""),
    (12, "ftp://EXAMPLE.com/en", ""),
    (13, "http://www.EXAMPLE.com/en/a?b", ""),
    (14, "http://notexample.com/en/", ""),
    (15, "http://com", ""),
    (16, "x://net/es/://y", ""),
]


def slow(pages):
    def parse(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)([^#]*)", u or "")
        return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2], m[3]) if m else ("", "", None)

    def rule(h, p):
        fit = [(len(rh + rp), a == "allow", rh + rp, a) for a, rh, rp in U.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        return max(fit)[2:] if fit else (None, None)
    edges = {"http://a.org/x": "https://b.example.net/es/1", "http://c.org/y": "http://a.org/x", "http://d.org/z": "http://www.example.com/en/9",
             "http://e.net/fr/1": "http://www.example.com/en/9", "http://f.org/": "http://f.org/other", "http://h.org/q": "http://k.net/fr/x"}
    pairs = [*edges.items(), ("http://i.org/q", "http://k.net/fr/x"), ("http://i.org/q", "http://z.com/a")]
    key = lambda u: parse(u)[0] + parse(u)[1] + parse(u)[2]
    group = {}
    for a, b in pairs:
        joined = group.get(key(a), {key(a): a}) | group.get(key(b), {key(b): b})
        for k in joined:
            group[k] = joined
    out = []
    for pid, url, _ in pages:
        h, p, rest = parse(url)
        name, action = rule(h, p)
        alias = False
        if action is None and rest is not None and key(url) in group:
            acts = {rule(*parse(u)[:2])[1] for u in group[key(url)].values()}
            action, alias = ("allow" if "allow" in acts else "block" if "block" in acts else "allow"), True
        out.append((pid, h, p, name, action or "allow", alias))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, host string")
    out = U.judge(df, U.rule_table(spark))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "alias"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == slow(PAGES)
    by = {g[0]: g for g in got}
    assert by[1][4] == by[3][4] == "block" and by[4][4] == "allow" and by[5][4] == "block" and by[8][4] == by[9][4] == "allow"
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(df, U.rule_table(spark)).count() == 0
    one = spark.createDataFrame([(1, "http://x.net/es/a", None)], "page_id long, url string, html string")
    assert U.judge(one, U.rule_table(spark, [("block", "x.net", "/")])).collect()[0].verdict == "block"
