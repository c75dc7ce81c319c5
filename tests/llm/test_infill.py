import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import infill as I

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, seed=42, rate=50, suffix_first=80):
    """(n, form, prefix, middle, suffix, output)"""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", prefix, middle, suffix, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, suffix, f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("n", [1, 2, 4, 5, 17, 100, 3000])
def test_seek_equals_running_sums(n):
    widths = np.random.default_rng(n).integers(1, 30, n)
    units, sums = I.SkipList(widths), np.concatenate(([0], np.cumsum(widths)))
    assert [units.seek(r)[0] for r in range(n + 1)] == sums.tolist()
    for below, above in zip(units.lanes, units.lanes[1:]):
        assert len(above[0]) < len(below[0]) and above[0].sum() == n and above[1].sum() == sums[-1]


def test_seek_passes_few_nodes():
    units = I.SkipList(np.ones(200_000, np.int64))
    assert max(units.seek(r)[1] for r in range(0, 200_001, 997)) < 150


def test_rows_equal_the_definition(spark, prose):
    rng = random.Random(5)
    alphabet = "ab \t\n\r\x0b\x0c é中\U0001f600<PSM>"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(i, prose(i, 30)) for i in range(400, 440)]
    rows += [(500, None), (501, ""), (502, " \n "), (503, "x"), (504, "a <M> b"), (505, prose(1, 60_000)), (None, "one two three"), (7, rows[7][1]), (8, "other text")]
    table = spark.createDataFrame([(i, t, 1, "m") for i, t in rows], "doc_id long, text string, n int, middle string").repartition(4)
    for settings in ({}, {"seed": 7, "rate": 100, "suffix_first": 30}):
        found = I.fill_in_middle(table, **settings)
        assert found.columns == ["doc_id", "n", "form", "prefix", "middle", "suffix", "output"]
        got = found.withColumn("again", I.restore(F.col("output"), F.col("form"))).collect()
        assert sorted((str(r["doc_id"]), *map(str, r[1:])) for r in got) == sorted(
            (str(i), *map(str, by_hand(i, t, **settings)), t or "") for i, t in rows
        )
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert I.fill_in_middle(table.limit(0)).count() == 0


def test_own_sentinels(spark):
    table = spark.createDataFrame([(i, f"a{i} b|c <P> d") for i in range(40)], "doc_id long, text string")
    marks = ("[pre|", "|suf]", "(mid)")
    found = I.fill_in_middle(table, rate=100, sentinels=marks)
    rows = found.withColumn("again", I.restore(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["form"] != "plain" and r["again"] == f"a{r['doc_id']} b|c <P> d" == r["prefix"] + r["middle"] + r["suffix"] for r in rows)
