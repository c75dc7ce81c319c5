"""Evaluation and blending of keyed prediction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.functions import scalars as X
from cohortlift.functions.joins import attach
from cohortlift.functions.ranking import buckets_for, quantile_buckets, running_total
from cohortlift.session import materialise


def _pairs_won(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Area from ``(by, bucket, pos, neg, won)`` rows, one row per bucket and group."""
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0))
    scored = groups.withColumn("won", F.col("won") + F.col("pos").cast("double") * below)
    out = scored.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.sum("won").alias("_won")
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return out.withColumn("auc", F.when(pairs > 0, F.col("_won") / pairs)).drop("_won")


def auc(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """Exact ROC-AUC with ties as ``(by..., n_pos, n_neg, auc)``; NULL when a class is absent.

    Rows shrink to distinct scores before they move; these are stored once, ordered within quantile buckets (as many as their
    number asks for, or ``n``), and only bucket totals are ordered per group.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    rows = rows.select(*by, F.col(p).cast("double").alias("p"), F.col(y).cast("int").alias("y"))
    scores = rows.groupBy(*by, "p").agg(
        F.sum("y").cast("bigint").alias("pos"), F.sum(1 - F.col("y")).cast("bigint").alias("neg")
    )
    scores = materialise(scores, "scores")
    bucketed = quantile_buckets(scores, {"p": "bucket"}, n or buckets_for(scores.count()))
    inner = Window.partitionBy(*by, "bucket").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inner), F.lit(0))
    won = F.col("pos") * (below + F.col("neg") / 2)
    groups = (
        bucketed.withColumn("won", won)
        .groupBy(*by, "bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    if by:
        return _pairs_won(groups, by)
    # One group: only its bucket rows meet in its window.
    return _pairs_won(groups.withColumn("_all", F.lit(0)), ["_all"]).drop("_all")


def blend(columns: Sequence[str], weights: Sequence[float]) -> Column:
    """Weighted mean with weights clipped at 0 and normalised."""
    clipped = [max(float(w), 0.0) for w in weights]
    total = sum(clipped)
    if total <= 0:
        raise ValueError("no positive weight")
    return reduce(add, (F.col(c) * F.lit(w / total) for c, w in zip(columns, clipped)))


def mean_blend(columns: Sequence[str]) -> Column:
    return reduce(add, (F.col(c) for c in columns)) / F.lit(float(len(columns)))


def pivot_members(preds: DataFrame, members: Sequence[str], keys: Sequence[str] = ("id", "y")) -> DataFrame:
    """Long predictions to one column per member, averaged over seeds and folds of the member."""
    return preds.groupBy(*keys).pivot("model", list(members)).agg(F.avg("p"))


def seed_mean(preds: DataFrame, keys: Sequence[str] = ("id", "model")) -> DataFrame:
    """Mean prediction over seeds."""
    return preds.groupBy(*keys).agg(F.avg("p").alias("p"))


def fold_mean(preds: DataFrame, keys: Sequence[str] = ("id", "model", "seed")) -> DataFrame:
    """Mean prediction over folds."""
    return preds.groupBy(*keys).agg(F.avg("p").alias("p"))


def whole_weights(weights: Sequence[float], n: int) -> list[float]:
    """``n`` weights: one that is not given is 1/n."""
    return (list(weights) + [1.0 / n] * n)[:n]


def _scored(wide: DataFrame, members: Sequence[str], candidates: Mapping[int, Sequence[float]], y: str) -> DataFrame:
    """A row per row and candidate; weights are looked up by the candidate's place, so that the plan does not grow with them."""
    shares = []
    for weights in candidates.values():
        clipped = [max(float(w), 0.0) for w in whole_weights(weights, len(members))]
        if sum(clipped) <= 0:
            raise ValueError("no positive weight")
        shares.append([w / sum(clipped) for w in clipped])
    each = wide.select(F.col(y).cast("int").alias("y"), *members, F.explode(F.sequence(F.lit(0), F.lit(len(shares) - 1))).alias("_at"))
    p = reduce(add, (F.col(m) * F.get(F.lit([s[i] for s in shares]), F.col("_at")) for i, m in enumerate(members)))
    return each.select("y", F.get(F.lit([int(i) for i in candidates]), F.col("_at")).alias("candidate"), p.alias("p"))


def score_edges(wide: DataFrame, members: Sequence[str], bins: int = 4096) -> list[float]:
    """Edges of bins that hold like many scores of the members and of their mean, wherever the scores lie."""
    scores = wide.select(F.explode(F.array(*[F.col(m).cast("double") for m in members], mean_blend(members))).alias("p"))
    found = scores.approxQuantile("p", [i / bins for i in range(1, bins)], 1.0 / (2 * bins))
    return sorted({float(e) for e in found})


def candidate_auc(
    wide: DataFrame,
    members: Sequence[str],
    candidates: Mapping[int, Sequence[float]],
    y: str = "y",
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """``(candidate, auc)`` of many weight vectors in one job; exact without ``edges``.

    With ``edges`` (see ``score_edges``) the state per task and the shuffle hold at most a row per candidate and bin
    whatever the data; scores of one bin count as tied.
    """
    scored = _scored(wide, members, candidates, y)
    if edges is None:
        return auc(scored, "y", "p", ["candidate"]).select("candidate", "auc")
    splits = [-float("inf"), *edges, float("inf")]
    binned = Bucketizer(splits=splits, inputCol="p", outputCol="bucket", handleInvalid="skip").transform(scored)
    binned = (
        binned.groupBy("candidate", "bucket")
        .agg(F.sum("y").cast("bigint").alias("pos"), F.sum(1 - F.col("y")).cast("bigint").alias("neg"))
        .withColumn("won", F.col("pos") * F.col("neg") / 2)
    )
    return _pairs_won(binned, ["candidate"]).select("candidate", "auc")


def search_weights(
    wide: DataFrame,
    members: Sequence[str],
    starts: Sequence[Sequence[float]],
    rounds: int = 12,
    step: float = 0.2,
    y: str = "y",
    bins: int = 4096,
    least_step: float = 0.005,
) -> tuple[list[float], float]:
    """Best weights found by scoring batches of candidates around every start; the AUC returned is exact.

    Each round is one job over the rows that moves all starts: one that finds nothing better halves its step, and rests
    below ``least_step``.  The exact AUC of the results is compared with those of the starts, so it is never below
    the best start.
    """
    n = len(members)
    edges = score_edges(wide, members, bins)

    def fit(w: Sequence[float]) -> tuple[float, ...]:
        w = [max(float(x), 0.0) for x in whole_weights(w, n)]
        total = sum(w)
        return tuple(round(x / total, 6) for x in w) if total > 0 else tuple([1.0 / n] * n)

    def areas(batch: Sequence[tuple[float, ...]]) -> dict[tuple[float, ...], float]:
        rows = candidate_auc(wide, members, dict(enumerate(batch)), y, edges).collect()
        return {batch[r["candidate"]]: r["auc"] or 0.0 for r in rows}

    def around(best: tuple[float, ...], step: float) -> list[tuple[float, ...]]:
        near = []
        for i in range(n):
            for d in (step, -step):
                w = list(best)
                w[i] = max(w[i] + d, 0.0)
                near.append(fit(w))
        for i, j in combinations(range(n), 2):
            for a, b in ((i, j), (j, i)):
                w = list(best)
                shift = min(step, w[a])
                w[a], w[b] = w[a] - shift, w[b] + shift
                near.append(fit(w))
        return [w for w in dict.fromkeys(near) if w != best]

    base = list(dict.fromkeys(fit(s) for s in [*starts, [1.0 / n] * n]))
    known = areas(base)
    points = [(w, step) for w in base]
    for _ in range(rounds):
        moves = [around(w, s) if s >= least_step else [] for w, s in points]
        new = [w for w in dict.fromkeys(w for m in moves for w in m) if w not in known]
        if new:
            known.update(areas(new))
        elif not any(moves):
            break
        for k, (w, s) in enumerate(points):
            best = max([w, *moves[k]], key=lambda x: known.get(x, 0.0))
            points[k] = (best, s) if known.get(best, 0.0) > known.get(w, 0.0) else (w, s / 2)
    finalists = list(dict.fromkeys([*(w for w, _ in points), *base]))
    exact = candidate_auc(wide, members, dict(enumerate(finalists)), y).collect()
    top = max(exact, key=lambda r: (r["auc"] or 0.0, -r["candidate"]))
    return list(finalists[top["candidate"]]), top["auc"]


def rank_normalise(
    df: DataFrame, p: str = "p", by: Sequence[str] = (), out: str = "rank_p", n: int | None = None
) -> DataFrame:
    """Average rank over the number of rows with a score, within ``by``; NULL where ``p`` is NULL.

    The distinct scores are stored once, and all that follows reads them.
    """
    groups = list(by) or ["_all"]
    scored = (df if by else df.withColumn("_all", F.lit(0))).where(F.col(p).isNotNull())
    counts = materialise(scored.groupBy(*groups, p).agg(F.count("*").alias("_n")), "scores")
    bucketed = quantile_buckets(counts, {p: "_bucket"}, n or buckets_for(counts.count()))
    ranked = running_total(bucketed, groups, "_bucket", [p], F.col("_n"), "_before").select(*groups, p, "_n", "_before")
    if by:
        sized = attach(ranked, counts.groupBy(*groups).agg(F.sum("_n").alias("_size")), groups)
    else:
        sized = ranked.withColumn("_size", F.lit(counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]))
    rank = (F.col("_before") + (F.col("_n") + 1) / 2) / F.col("_size")
    return attach(df, sized.select(*by, p, rank.alias(out)), [*by, p])


def member_correlations(wide: DataFrame, members: Sequence[str]) -> DataFrame:
    """``(a, b, corr)`` of every pair of members in one pass."""
    pairs = list(combinations(members, 2))
    one = wide.agg(
        *[
            F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias(f"{a}|{b}")
            for a, b in pairs
        ]
    )
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    parts = F.split("pair", "[|]")
    return long.select(parts[0].alias("a"), parts[1].alias("b"), "corr")


def best_member(scores: DataFrame, name: str = "model", value: str = "auc") -> DataFrame:
    """The member with the highest AUC."""
    return scores.agg(F.max_by(name, value).alias(name), F.max(value).alias(value))


def summary(preds: DataFrame, by: Sequence[str] = (), p: str = "p") -> DataFrame:
    """Mean and sample standard deviation."""
    return preds.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.stddev_samp(p).alias("std_p")
    )
