import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import warc as A
from tessera.session import scratch_path


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 50))
def test_chunked_round_trip(payload, size):
    assert A.dechunked(A.chunked(payload, size)) == payload


def test_broken_records():
    assert A.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        A.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(A.parse(A.record([("WARC-Type", "x")], b"abc")[:-1] + A.END))


def slow(rows):
    least = {}
    for p, _, h, *_ in rows:
        if p is not None:
            least[h or ""] = min(p, least.get(h or "", p))
    out = []
    for p, _, h, *_ in rows:
        b = (h or "").encode()
        first = least.get(h or "")
        out.append((p, len(b), A.payload_digest(b), "response" if p == first else "revisit", None if p == first else first))
    return sorted(out, key=str)


def pages():
    r = random.Random(1)
    text = lambda n: "".join(r.choice("ab<é\r\n\x00 🙂") for _ in range(n))
    rows = [(i, f"http://h/{i}", text(r.randint(0, 300)), "x") for i in range(60)]
    rows += [(100, "u\r\nX-Page-ID: 5", rows[3][2], "x"), (101, None, None, "x"), (102, "http://é/ß", "", "x"), (-4, "", rows[5][2], "x"),
             (7, "http://h/7", rows[7][2], "x"), (None, "n", "only null"), (None, "n", rows[9][2]), (103, "w", "WARC/1.1\r\n\r\n\r\n" * 90),
             (104, "long", text(60_000)), (105, "edge", "a" * 4096 * 3), (106, "copy of long", None)]
    rows = [(*x[:3], "x") for x in rows]
    return rows + [(107, "again", rows[-3][2], "x")]


@pytest.mark.parametrize("segment,files", [(100, 7), (16384, 2048)])
def test_round_trip(spark, segment, files):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, digest string")
    path = scratch_path(spark, "warc")
    A.write_archives(df, path, segment, files)
    assert sorted(map(tuple, A.read_archives(spark, path).collect()), key=str) == slow(pages())


def test_lost_segment_is_noticed(spark):
    parts = list(A.page_records(1, "u", b"x" * 500, 1, 0, 100))
    path = scratch_path(spark, "warc")
    kept = [(p.decode(),) for p in parts[:2] + parts[3:]]
    spark.createDataFrame(kept, "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
    with pytest.raises(Exception, match="segments missing"):
        A.read_archives(spark, path).collect()


def test_empty(spark):
    path = scratch_path(spark, "warc")
    A.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert A.read_archives(spark, path).count() == 0
