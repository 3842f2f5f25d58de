"""Block-max search gives the lists of scoring and testing every document."""
import random

import pytest

from tessera.operators import index as IX, search as SR
from tessera.session import written

DOCS = "doc_id long, title string, text string, actors array<string>, directors array<string>, writer string"


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    words = ["ring", "string", "stone", "Été", "hill", "the"] + [f"w{i}" for i in range(60)]
    people = ["Ann Cage", "Bo Hill", "Cy Ring", "Di O'Stone", "Ed Été"]
    rows = []
    for i in range(400):
        text = " ".join(r.choices(words, k=r.choice([1, 3, 10, 40, 200])))
        rows.append((i, r.choice(["Hill", "Other film", ""]), text, r.sample(people, r.randint(0, 2)), r.sample(people, r.randint(0, 1)),
                     r.choice(["Cage", "", None, "Nobody"])))
    rows += [(1000 + i, "same", "ring ring hill", [], [], "") for i in range(30)]         # ties, by doc_id
    docs = spark.createDataFrame(rows, DOCS)
    dt = written(IX.doc_terms(docs), "t-terms")
    post = IX.postings_from_terms(IX.with_blocks(dt, 8), 3)
    return written(post, "t-post"), written(IX.idf_from_terms(dt), "t-idf"), written(IX.docstore(docs), "t-store")


def queries(spark):
    asked = ["ring", "Cage", "hill", "ring hill", "ring ring stone", "tone", "Hill Cage", "nowhere", "", "Ring string", "the", "w3 w4 w5", "été Été"]
    return spark.createDataFrame(list(enumerate(asked)), "query_id long, q string")


def every(queries, post, idf, store, fields, shard_limit, limit):
    docs = {r.doc_id: r for r in store.collect()}
    terms = {r.query_id: r.q.split(" ") for r in queries.collect()}
    out = {}
    for r in SR.score(queries, post, idf).collect():
        text = [(docs[r.doc_id].title + docs[r.doc_id].text)] if fields == "plot" else [docs[r.doc_id][c] for c in ("actors", "directors", "writer")]
        if any(t and t.lower() in x.lower() for t in terms[r.query_id] for x in text):
            out.setdefault(r.query_id, []).append((r.score, r.doc_id, r.shard))
    kept = set()
    for q, rows in out.items():
        rows.sort(reverse=True)
        seen = {}
        ranked = []
        for s, d, shard in rows:
            seen[shard] = seen.get(shard, 0) + 1
            if shard_limit is None or seen[shard] <= shard_limit:
                ranked.append((q, len(ranked) + 1, d, round(s, 9)))
        kept |= set(ranked[:limit])
    return kept


@pytest.mark.parametrize("shard_limit,limit", [(None, 10), (2, 10), (30, 3)])
def test_lists_equal_those_of_all_documents(spark, corpus, shard_limit, limit):
    post, idf, store = corpus
    q = queries(spark)
    for fields, fn in (("plot", SR.search_plot), ("person", SR.search_person)):
        want = every(q, post, idf, store, fields, shard_limit, limit)
        for maxima in (None, IX.block_maxima(post)):
            got = fn(q, post, idf, store, shard_limit=shard_limit, limit=limit, maxima=maxima).collect()
            assert {(r.query_id, r["rank"], r.doc_id, round(r.score, 9)) for r in got} == want
    assert len(want) > 10


def test_blocks_under_the_floor_are_not_scored(spark, corpus, monkeypatch):
    post, idf, store = corpus
    q = queries(spark).where("q in ('ring', 'the')")
    seen = {}
    real = SR.written

    def watch(df, name):
        out = real(df, name)
        seen[name] = out
        return out
    monkeypatch.setattr(SR, "written", watch)
    top = SR.block_max_top(q, post, idf, store, None, "in_content").count()
    scored = SR.score(q, post, idf).count()
    assert top == 20 and seen["query-floors"].count() == 2
    assert 20 <= seen["query-hits"].count() < 0.6 * scored
    assert seen["query-hits"].where("not sure").count() == 0     # so no text was read for the filter


def test_written_index_holds_the_maxima(spark, corpus, tmp_path):
    post, idf, store = corpus
    IX.write_index(post, idf, store, str(tmp_path / "ix"))
    got = {(r.term, r.block): r.max_tf for r in IX.read_maxima(spark, str(tmp_path / "ix")).collect()}
    want = {}
    for r in post.collect():
        want[r.term, r.block] = max(r.tf, want.get((r.term, r.block), 0))
    assert got == want
    back = IX.read_index(spark, str(tmp_path / "ix"))
    assert {"block", "in_content", "in_people"} <= set(back[0].columns)
