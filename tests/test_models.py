from threading import Barrier

import pytest
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.operators import evaluate as E
from cohortlift.operators import models as G
from cohortlift.plans import workflow
from cohortlift.plans.base import split
from cohortlift.operators.clean import clean
from cohortlift.operators.features import derive
from cohortlift.plans.base import train_medians
from cohortlift.session import materialise, scratch_path
from cohortlift.sources import sinks

FEATURES = ("embryos_total", "embryos_transferred", "day_transfer", "age_median", "age_x_embryo_ratio", "ratio_icsi_success", "no_transfer")
CATEGORIES = ("period_code", "age_band", "specific_type")
TREES = {"numTrees": 10, "maxDepth": 5}


@pytest.fixture(scope="module")
def sides(spark, medium):
    train, test = split(spark, medium)
    medians = train_medians(train)
    keep = ["id", *FEATURES, *CATEGORIES]
    return (
        materialise(derive(clean(train, "clean", medians)).select(*keep, S.TARGET), "train"),
        materialise(derive(clean(test, "clean", medians)).select(keep), "test"),
    )


@pytest.fixture(scope="module")
def forest(sides):
    config = G.ModelConfig("forest", FEATURES, CATEGORIES, "forest", (42, 7), TREES)
    oof, pred = G.train_oof(*sides, config)
    return oof.persist(), pred.persist()


def test_each_row_is_predicted_once_per_seed(sides, forest):
    oof, pred = forest
    n, m = sides[0].count(), sides[1].count()
    counts = oof.groupBy("seed").agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")).collect()
    assert [(r["n"], r["d"]) for r in counts] == [(n, n)] * 2
    assert pred.count() == m * 2 * 5
    assert oof.where("p < 0 or p > 1 or p is null").count() == 0
    assert oof.where("y is null").count() == 0


def test_signal_is_found(forest):
    assert E.auc(E.seed_mean(forest[0], ["id", "model", "y"])).first()["auc"] > 0.6


def test_same_seed_same_output(sides):
    config = G.ModelConfig("f", FEATURES, (), "forest", (3,), {"numTrees": 3, "maxDepth": 3})
    first, second = ({r["id"]: r["p"] for r in G.train_oof(*sides, config, k=2)[0].collect()} for _ in range(2))
    assert first == second


def test_fits_side_by_side_share_no_local_properties(spark):
    both, context = Barrier(2, timeout=60), spark.sparkContext

    def task(name):
        context.setLocalProperty("spark.cohortlift.test", name)
        both.wait()
        return context.getLocalProperty("spark.cohortlift.test")

    assert G.in_parallel(spark.range(1), [lambda: task("a"), lambda: task("b")], 2) == ["a", "b"]
    assert context.getLocalProperty("spark.cohortlift.test") is None


def test_rows_with_features_are_not_broadcast(sides, monkeypatch):
    plans = []

    def kept(df, name, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, name, *rest)

    monkeypatch.setattr(G, "materialise", kept)
    G.train_oof(*sides, G.ModelConfig("f", FEATURES, (), "forest", (3,), {"numTrees": 2, "maxDepth": 2}), k=2)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0]


def test_few_fits_run_at_once(spark):
    slots = spark.sparkContext.defaultParallelism
    assert G.at_once(spark.range(1), 8, 1) == min(G.FITS_AT_ONCE, slots)
    assert G.at_once(spark.range(1), 8, 10 * slots) == 1


def test_a_fit_takes_its_share_of_the_cores(spark):
    share = -(-spark.sparkContext.defaultParallelism // G.FITS_AT_ONCE)
    df = spark.range(1)
    assert G.fit_tasks(df, 0) == G.fit_tasks(df, G.ROWS_PER_TASK) == 1
    assert G.fit_tasks(df, 100 * G.ROWS_PER_TASK) == max(share, 100 * G.ROWS_PER_TASK // G.MOST_ROWS_PER_TASK)
    assert G.fit_tasks(df, 1000 * G.MOST_ROWS_PER_TASK) == max(share, 1000)


def test_trees_write_no_table_of_nodes(sides):
    for learner in ("gbt", "gbt_deep", "forest", "residual"):
        config = G.ModelConfig("x", FEATURES, (), learner)
        assert not G.make_learner(config, G.fit_vectors(sides[0], config), 1).getCacheNodeIds()


def test_segments_cover_all_rows(sides):
    config = G.ModelConfig("s", FEATURES, (), "forest", (42,), {"numTrees": 3, "maxDepth": 3})
    oof, pred = G.train_by_segment(*sides, "no_transfer", {0: config, 1: config}, k=2)
    assert oof.select("id").distinct().count() == oof.count() == sides[0].count()
    assert pred.count() == 2 * sides[1].count()


def test_residual_stays_in_range(sides, forest):
    oof, pred = (E.fold_mean(part, ["id"]) for part in forest)
    config = G.ModelConfig("r", FEATURES, (), "residual", (42,), {"maxIter": 2, "maxDepth": 3})
    fixed, ahead = G.train_residual(*sides, oof, pred, config, k=2)
    fixed = fixed.persist()
    assert fixed.count() == sides[0].count() and fixed.where("p < 0 or p > 1").count() == 0
    assert ahead.count() == ahead.select("id").distinct().count() == sides[1].count()  # folds are averaged before the clip
    assert E.auc(fixed).first()["auc"] > 0.6


def test_wide_categories_become_codes(sides):
    config = G.ModelConfig("x", ("embryos_total",), ("key", "age_band"), "forest")
    rows = sides[0].withColumn("key", F.format_string("k%08d", "id"))
    vectors = G.fit_vectors(rows, config)
    assert vectors.wide == ("key",) and vectors.categories == ("age_band",) and vectors.max_bins < 100
    last = G.vector_to_array("features")[2]
    coded = vectors.transform(rows, S.TARGET).select("id", last.alias("code"))
    assert coded.count() == rows.count() and coded.select("code").distinct().count() == rows.count()
    unseen = vectors.transform(rows.withColumn("key", F.lit("new")), S.TARGET).select(last.alias("code"))
    assert [r["code"] for r in unseen.distinct().collect()] == [-1.0]


def test_segments_without_member_are_refused(sides):
    config = G.ModelConfig("s", FEATURES, (), "forest", (42,), {"numTrees": 3, "maxDepth": 3})
    with pytest.raises(ValueError, match="no member"):
        G.train_by_segment(*sides, "no_transfer", {0: config})


def test_members_train_on_their_categories(spark, small):
    ready = workflow.prepare(*split(spark, small))
    configs = {c.name: c for c in G.members(ready.sets, ready.categories)}
    texts = {"age_band", "treatment_type", "specific_type", "embryo_reason", "egg_source", "sperm_source"}
    for name in ("gbt_v3", "gbt_v3_te", "deep_v3", "deep_full", "forest_full"):
        assert texts <= set(configs[name].categories), name
        assert not texts & set(configs[name].features)
    assert [c.name for c in workflow.configs(ready)] == ["gbt_v3", "gbt_v3_te", "deep_v3", "deep_full", "segments", "forest_full", "residual"]


def test_missing_values_get_a_flag(sides):
    vectors = G.fit_vectors(sides[0], G.ModelConfig("x", ("embryos_total", "ratio_icsi_success"), (), "forest"))
    assert vectors.flagged == ("ratio_icsi_success",)


def test_stack_reports_unseen_and_seen_area(spark, forest):
    oof, pred = forest
    names = ["42", "7"]
    wide = oof.groupBy("id", "y").pivot("seed", [42, 7]).agg(F.avg("p"))
    ahead = pred.groupBy("id").pivot("seed", [42, 7]).agg(F.avg("p"))
    nested, stacked, scores = G.stack(wide, ahead, names, cs=(0.1, 1.0), k=3)
    assert nested.count() == wide.count() and stacked.count() == ahead.count()
    assert scores["c"] in (0.1, 1.0) and scores["nested_auc"] > 0.6
    assert scores["in_sample_auc"] == pytest.approx(scores["nested_auc"], abs=0.02)


def test_prepared_tables(spark, small):
    ready = workflow.prepare(*split(spark, small))
    assert set(ready.sets) == {"v3", "v3_te", "full", "full_cat"}
    assert "period_code" not in ready.sets["v3_te"] and "period_te" in ready.sets["v3_te"]
    assert ready.train.count() == 1500 - ready.test.count()
    assert ready.train.where("TE__proc_age is null or period_te is null").count() == 0
    assert ready.test.where("TE__proc_age is null or period_te is null").count() == 0


@pytest.fixture(scope="module")
def boosted(sides):
    config = G.ModelConfig("b", FEATURES, CATEGORIES, "gbt", (42, 7), {"maxIter": 5, "maxDepth": 3, "minInstancesPerNode": 20})
    return G.cross_fit(*sides, config, k=2)


def test_truncated_model_equals_a_shorter_fit(boosted):
    rows = boosted.rows.select("id", "y", "features", "fold_42").where("fold_42 = 0").coalesce(1)
    long, short = (G.make_learner(G.replace(boosted.config, params={**boosted.config.params, "maxIter": n}), boosted.vectors, 42).fit(rows) for n in (5, 2))
    cut = G.truncated(long, 2)
    assert cut.getNumTrees == 2 and cut.getFeaturesCol() == "features"
    p = G.vector_to_array("probability")[1]
    both = cut.transform(rows).select("id", p.alias("a")).join(short.transform(rows).select("id", p.alias("b")), "id")
    assert both.where("a <> b").count() == 0 and both.count() == rows.count()


def test_truncated_regression(boosted):
    rows = boosted.rows.select("id", (F.col("y") - 0.3).alias("y"), "features").coalesce(1)
    config = G.replace(boosted.config, learner="residual")
    long, short = (G.make_learner(G.replace(config, params={**config.params, "maxIter": n}), boosted.vectors, 42).fit(rows) for n in (4, 2))
    both = G.truncated(long, 2).transform(rows).select("id", "prediction").exceptAll(short.transform(rows).select("id", "prediction"))
    assert both.count() == 0


def test_patience():
    losses = [5.0, 4.0, 4.5, 4.4, 3.0, 3.5]
    assert G.best_prefix(losses) == 5 and G.best_prefix(losses, 2) == 2 and G.best_prefix(losses, 3) == 5 and G.best_prefix([1.0]) == 1


def test_stopping_is_reported(sides):
    config = G.ModelConfig("b", FEATURES, (), "gbt", (42,), {"maxIter": 6, "maxDepth": 6, "stepSize": 1.0, "minInstancesPerNode": 1})
    fitted = G.cross_fit(*sides, config, k=2, patience=1)
    assert [r[:3] for r in fitted.rounds()] == [("b", 42, 0), ("b", 42, 1)] and all(1 <= r[3] < 6 for r in fitted.rounds())


def test_mean_scores_equal_the_long_form(sides, boosted):
    long = E.fold_mean(boosted.test_by_model(), ["id"]).withColumnRenamed("p", "q")
    both = boosted.test().join(long, "id")
    assert boosted.test().count() == both.count() == sides[1].count()
    assert both.where("abs(p - q) > 1e-12").count() == 0
    plan = boosted.test()._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_folds_of_all_seeds_in_one_table(sides):
    from cohortlift.operators.folds import assign_folds, fold_columns

    wide = fold_columns(sides[0], seeds=S.SEEDS)
    assert wide.count() == sides[0].count() and wide.columns == ["id", *[f"fold_{s}" for s in S.SEEDS]]
    for seed in S.SEEDS[:2]:
        one = assign_folds(sides[0].select("id", S.TARGET), seeds=(seed,), digits=3).select("id", F.col("fold").alias(f"fold_{seed}"))
        assert one.exceptAll(wide.select("id", f"fold_{seed}")).count() == 0


def test_halving_rungs_and_choice(sides):
    assert G.rungs(7, 3) == [(1 / 9, 7), (1 / 3, 3), (1.0, 1)] and G.rungs(1, 3) == [(1.0, 1)]
    candidates = (
        G.Candidate("forest", (("numTrees", 2), ("maxDepth", 1))), G.Candidate("forest", (("numTrees", 5), ("maxDepth", 5))), G.Candidate("logistic"),
    )
    config = G.ModelConfig("choice", FEATURES, CATEGORIES)
    report, ahead = G.select_learner(*sides, config, candidates, eta=2, k=2)
    rows = report.orderBy("rung").collect()
    assert [r["rung"] for r in rows] == [0, 0, 0, 1, 1, 2] and rows[-1]["n_rows"] == sides[0].count()
    first = sorted((r for r in rows if r["rung"] == 0), key=lambda r: -r["auc"])
    assert {r["candidate"] for r in rows if r["rung"] == 1} == {r["candidate"] for r in first[:2]}
    assert rows[0]["n_rows"] == sides[0].where(G.share_of(F.col("id")) < 0.25).count()
    assert ahead.count() == sides[1].count() and ahead.where("p < 0 or p > 1 or p is null").count() == 0


def test_fingerprint_knows_columns_and_cells(spark):
    rows = spark.range(100).select("id", (F.col("id") * 2).alias("a"), F.col("id").cast("string").alias("b"))
    first = sinks.fingerprint(rows)
    assert sinks.fingerprint(rows.repartition(7).orderBy(F.desc("id"))) == first
    changed = sinks.fingerprint(rows.withColumn("a", F.when(F.col("id") == 5, 0).otherwise(F.col("a"))))
    assert changed["b"] == first["b"] and changed["a"] != first["a"]
    assert sinks.fingerprint(rows.unionByName(rows.where("id = 3")))["b"] != first["b"]
    swapped = rows.withColumn("a", F.when(F.col("id") == 5, 12).when(F.col("id") == 6, 10).otherwise(F.col("a")))
    assert sinks.fingerprint(swapped)["a"] != first["a"] and set(sinks.fingerprint(rows.limit(0)).values()) == {"0"}


SMALL = dict(rounds=1, seeds=(42,), few_seeds=(42,), search_rounds=1, k=2)


@pytest.mark.parametrize("profile", ["clean", "raw"])
def test_whole_run(spark, small, profile, monkeypatch):
    train, test = (materialise(side, "side") for side in split(spark, small))
    store = scratch_path(spark, "store")
    done = workflow.run(train, test, profile=profile, store=store, **SMALL)
    scores = {r["model"]: r["auc"] for r in done.scores.collect()}
    wanted = {"gbt_v3", "gbt_v3_te", "deep_v3", "deep_full", "segments", "forest_full", "blend"}
    assert set(scores) == wanted | ({"residual", "stack", "stack_in_sample"} if profile == "clean" else set())
    assert scores["blend"] >= max(scores[m] for m in ("gbt_v3", "deep_full")) - 0.05
    assert sum(done.weights) == pytest.approx(1.0, abs=1e-5)
    assert done.test.groupBy("model").count().where(f"count <> {test.count()}").count() == 0
    assert {r["rounds"] for r in done.rounds.where("model = 'gbt_v3'").collect()} == {1}

    template = test.select("id", F.lit(0.0).alias("probability"))
    paths = workflow.write(done, template, scratch_path(spark, "run"))
    assert set(paths) == {"blend", "best", "train_v3", "train_full", "test_v3", "test_full"} | ({"stack"} if profile == "clean" else set())
    back = spark.read.schema("id bigint, p double").option("header", True).csv(paths["best"])
    assert back.count() == test.count() and back.where("p is null or p < 0 or p > 1").count() == 0
    for side, rows in (("train", train), ("test", test)):
        for name in ("v3", "full"):
            table = spark.read.option("header", True).csv(paths[f"{side}_{name}"])
            assert table.columns == ["id", *done.ready.sets[name], *([S.TARGET] if side == "train" else [])] and table.count() == rows.count()

    # A second run fits nothing; a change refits what it touches.
    fits = []
    make = G.make_learner
    monkeypatch.setattr(G, "make_learner", lambda config, *rest: fits.append(config.name) or make(config, *rest))
    monkeypatch.setattr(G, "stack", lambda *a, **k: pytest.fail("the stack was fitted again"))
    again = workflow.run(train, test, profile=profile, store=store, **SMALL)
    assert not fits and {r["model"]: r["auc"] for r in again.scores.collect()} == scores
    ready = workflow.prepare(train, test, k=2, profile=profile, store=store)
    configs = {c.name: c for c in workflow.configs(ready, 1, (42,), (42,))}
    workflow.fit_member(ready, configs["gbt_v3"], k=2, patience=5)
    assert not fits
    workflow.fit_member(ready, G.replace(configs["gbt_v3"], seeds=(42, 7)), k=2, patience=5)
    assert set(fits) == {"gbt_v3"}
    fits.clear()
    fewer = G.replace(configs["deep_v3"], features=configs["deep_v3"].features[:-1])
    workflow.fit_member(ready, fewer, k=2, patience=5)
    assert set(fits) == {"deep_v3"}
    fits.clear()
    cell = train.withColumn(
        "day_embryo_thaw", F.when(F.col("id") == train.agg(F.min("id")).first()[0], 99.0).otherwise(F.col("day_embryo_thaw"))
    )
    changed = workflow.prepare(cell, test, k=2, profile=profile, store=store)
    touched = {c for c in changed.marks["train"] if changed.marks["train"][c] != ready.marks["train"][c]}
    assert touched and "age_ord" not in touched
    kept = tuple(c for c in configs["gbt_v3"].features if c not in touched)
    for tables in (ready, changed):
        workflow.fit_member(tables, G.replace(configs["gbt_v3"], features=kept[:8], categories=()), k=2, patience=5)
    assert fits == ["gbt_v3"] * 2  # two folds, once


def test_chosen_learner_fills_the_template(spark, small):
    train, test = split(spark, small)
    candidates = (G.Candidate("logistic"), G.Candidate("forest", (("numTrees", 3), ("maxDepth", 4))))
    report, ahead, area = workflow.choose(train, test, candidates, k=2, eta=2)
    assert report.count() == 3 and 0.5 < area < 1
    path, stats = sinks.write_submission(test.select("id", F.lit(0.0).alias("probability")), ahead, scratch_path(spark, "choice"), area, "choice")
    assert stats.first()["n"] == test.count() and "submission_choice_AUC" in path
