import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlift.llm import tiling as T


def greedy(doc, item, least):
    """Tiles by the definition: mark the longest match on unmarked words, ties by place in the item, then the document."""
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n] and free_d[d + n] and free_i[i + n]:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, i, d)
        if best is None:
            return tiles
        n, i, d = best
        tiles.append((d, i, n))
        for k in range(n):
            free_d[d + k] = free_i[i + k] = False


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=30), st.lists(st.integers(0, 3), min_size=2, max_size=14))
def test_tiles_equal_the_definition(doc, item):
    block = T.Seeds([(1, np.array(item, np.uint64).tobytes())], 2)
    words = np.array(doc, np.uint64)
    at, _, place = block.shared(T.W.grams(words, 2)) if len(doc) > 1 else (np.zeros(0, int),) * 3
    got = T.tile(words, block.words[0], at, place, 2) if len(at) else []
    assert sorted(got) == sorted(greedy(doc, item, 2))


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def test_equals_brute_force(spark, prose):
    rng = random.Random(4)
    items = [(i, prose(i, 20 + i)) for i in range(12)] + [(50, "too short"), (51, None), (52, ""), (3, "other words under a used name here")]
    rows = []
    for k in range(30):
        body, item = prose(100 + k, 30).split(), items[k % 12][1].split()
        cut = rng.randint(0, len(item))
        moved = item[cut:] + ["in", "between"] + item[:cut]  # reordered
        rows.append((k, " ".join(body[:10] + moved[: rng.randint(0, len(moved))] + body[10:])))
    rows += [(100, None), (101, ""), (102, items[2][1].upper().replace(" ", "!! ")), (102, items[2][1]), (None, items[4][1]), (103, "te " * 20_000 + items[5][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, doc_id double")
    want = []
    for d, t in rows:
        for i, u in items:
            if len(words(u)) >= 5 and (found := greedy(words(t), words(u), 5) if len(words(t)) < 5000 else [(0, 0, len(words(u)))] * (u == items[5][1])):
                want.append((d, i, len(words(u)), sum(x[2] for x in found)))
    for blocks in (1 << 20, 60, 25):  # of the last, most items are longer than a block
        got = T.tilings(docs, bench, block_words=blocks).collect()
        found = [(r["doc_id"], r["item_id"], r["item_words"], r["covered"]) for r in got]
        assert sorted(found, key=str) == sorted(want, key=str)
    assert T.contaminated(T.tilings(docs, bench)).where("doc_id = 102").count() == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert T.tilings(docs.limit(0), bench).count() == 0 and T.tilings(docs, bench.limit(0)).count() == 0
    row = T.tilings(docs, bench).first()
    assert row["coverage"] == 1 and [tuple(t) for t in row["tiles"]] == [(0, 0, 6)]
