import random

import pytest

from cohortlift.llm import revisits as R

RECORD = "record_id long, record_type string, url string, ts long, headers map<string,string>, payload string, state string, b int"


def test_canonical_urls(spark):
    cases = {
        "HTTP://user@WWW2.Host.org:80/Path/?b=2&utm_source=x&a=1#top": "host.org/Path?a=1&b=2",
        "https://host.org": "host.org", "https://host.org/": "host.org", "host.org//": "host.org", "https://a.b:8080/x.html?": "a.b:8080/x.html",
        "https://h/p?REF=1&reference=2": "h/p?reference=2", "": None, "#x": None, None: None,
    }
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", R.canonical_url(R.F.col("u")).alias("k")).collect()
    assert {r["u"]: r["k"] for r in got} == cases


def test_merging_and_states(spark):
    full = {"ETag": 'W/"2"', "Content-Type": "t", "Cache-Control": "old", "X": "1"}
    rows = [
        (1, "response", "http://h/a", 10, full, "p1"), (2, "response", "http://h/a", 20, {"Last-Modified": "d"}, "p2"),
        (3, "revisit", "https://www.h/a/", 15, {"etag": '"2"', "cache-control": "new", "Content-Type": "no", "connection": "close", "n": None}, None),
        (4, "revisit", "h/a", 15, {"etag": '"3"'}, "own"), (5, "revisit", "h/a", 30, {"last-modified": "d", "etag": '"2"'}, None),
        (6, "revisit", "h/a", 10, {"etag": '"2"'}, None), (7, "revisit", None, 15, {"etag": '"2"'}, None), (8, "revisit", "h/a", None, None, None),
        (9, "metadata", "h/a", 12, None, "m"), (10, None, None, None, None, None), (11, "revisit", "h/a", 40, {}, None),
    ]
    got = {r["record_id"]: r for r in R.resolve_revisits(spark.createDataFrame([(*r, "x", 1) for r in rows], RECORD)).collect()}
    state = {i: (r["state"], r["source_id"], r["payload"]) for i, r in got.items()}
    assert state == {
        1: ("response", 1, "p1"), 2: ("response", 2, "p2"), 3: ("resolved", 1, "p1"), 4: ("mismatch", None, None), 5: ("resolved", 2, "p2"),
        6: ("missing", None, None), 7: ("missing", None, None), 8: ("missing", None, None), 9: ("other", None, "m"), 10: ("other", None, None), 11: ("mismatch", None, None),
    }
    assert got[3]["headers"] == {"etag": '"2"', "content-type": "t", "cache-control": "new", "x": "1"}
    assert got[8]["headers"] == {}


@pytest.mark.parametrize("bucket_rows", [500_000, 40])
def test_equals_brute_force_with_one_hot_url(spark, bucket_rows):
    rng = random.Random(1)
    rows = []
    for i in range(500):
        url = "h/hot" if i % 2 else f"h/{rng.randint(0, 9)}"
        rows.append((i, rng.choice(["response", "revisit"]), url, rng.randint(0, 300), {"etag": rng.choice("ab")}, f"p{i}"))
    rows += [(1000, "revisit", "h/hot", 10_000, {"etag": "a"}, "long" * 100_000)]
    want = {}
    for i, kind, url, ts, head, _ in rows:
        if kind == "revisit":
            earlier = [(t, j, h) for j, k, u, t, h, _ in rows if k == "response" and u == url and t < ts]
            last = max(earlier, key=lambda x: x[:2], default=None)
            want[i] = ("missing", None) if last is None else ("resolved", last[1]) if last[2] == head else ("mismatch", None)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], RECORD).repartition(4)
    got = {r["record_id"]: (r["state"], r["source_id"]) for r in R.resolve_revisits(docs, bucket_rows=bucket_rows).collect() if r["state"] not in ("response", "other")}
    assert got == want


def test_no_rows(spark):
    assert R.resolve_revisits(spark.createDataFrame([], RECORD)).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "h/x", "")], "page_id long, url string, html string")
    assert R.resolve_revisits(R.records_of_pages(pages)).count() == 4
