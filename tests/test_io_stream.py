from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.operators.clean import clean
from cohortlift.operators.features import derive
from cohortlift.session import scratch_path
from cohortlift.sources import sinks, tables
from cohortlift.sources.cycles import cycles_from, read_cycles
from cohortlift.streaming.score import run_available


def write_lines(spark, lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_sampled_schema_and_late_conflicts(spark):
    path = write_lines(spark, ["ID,a,b,c", *[f"{i},{i}.5,x{i}," for i in range(50)], "50,late,y,1", "51,7,z,2"])
    schema = tables.sample_schema(spark, path, rows=20)
    assert [f.dataType.simpleString() for f in schema] == ["string", "double", "string", "double"]
    found = {r["column"]: r["n_conflict"] for r in tables.conflicts(spark, path, schema).collect()}
    assert found == {"ID": 0, "a": 1, "b": 0, "c": 0}
    bad = tables.read_reporting(spark, path, schema).cache().where(f"{tables.CORRUPT} is not null").collect()
    assert [r["ID"] for r in bad] == ["50"] and bad[0][tables.CORRUPT].startswith("50,late")


def test_csv_round_trip_under_source_headers(spark, small):
    rows = read_cycles(spark, small).drop("split")
    path = scratch_path(spark, "csv")
    tables.to_headers(rows).write.option("header", True).csv(path)
    back = tables.read_table(spark, path, fmt="csv", header="source")
    assert back.columns == [c.name for c in S.COLUMNS]
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in back.schema])
    assert typed.exceptAll(back).count() == 0 and back.exceptAll(typed).count() == 0


def test_missing_input_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_table(spark, "/tmp/there-is-no-such-table").count()
    with pytest.raises(ValueError):
        tables.read_table(spark, "/tmp/x", fmt="other")


def test_submission_is_clipped_and_named(spark):
    template = spark.createDataFrame([("t1", 0.0), ("t2", 0.0), ("t3", 0.0)], "ID string, probability double")
    preds = spark.createDataFrame([("t1", 1.2), ("t2", -0.1), ("t3", 0.4)], "ID string, p double")
    path, stats = sinks.write_submission(template, preds, scratch_path(spark, "out"), 0.74119, "ensemble", id="ID")
    assert "submission_ensemble_AUC0.74119_" in path
    back = spark.read.option("header", True).csv(path).orderBy("ID").collect()
    assert [float(r["probability"]) for r in back] == [1.0, 0.0, 0.4]
    row = stats.first()
    assert row["n"] == 3 and row["mean_p"] == pytest.approx(1.4 / 3)
    assert sinks.submission_name("a", 0.5, datetime(2024, 3, 4, 5, 6)) == "submission_a_AUC0.50000_0304_0506"


def test_store_is_keyed_by_configuration(spark):
    root = scratch_path(spark, "store")
    one = spark.createDataFrame([(1, 0, "m", 42, 0, 0.5)], "id int, y int, model string, seed int, fold int, p double")
    calls = []

    def build():
        calls.append(1)
        return {"oof": one.withColumn("p", F.lit(float(len(calls)))), "test": one.limit(0)}

    first = sinks.stored(spark, root, {"model": "m", "rounds": 5}, build)["oof"]
    again = sinks.stored(spark, root, {"rounds": 5, "model": "m"}, build)["oof"]
    assert len(calls) == 1 and first.first()["p"] == again.first()["p"] == 1.0
    sinks.stored(spark, root, {"model": "m", "rounds": 6}, build)
    assert len(calls) == 2
    assert sinks.stored(spark, root, {"model": "m", "rounds": 5}, build, recompute=True)["oof"].first()["p"] == 3.0
    assert sinks.load_predictions(spark, root, {"model": "other"}, "oof") is None


def test_stream_reads_each_file_once_and_equals_batch(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    source, out, state = (scratch_path(spark, n) for n in ("source", "out", "state"))

    def transform(df):
        return derive(clean(cycles_from(df), "clean", {"years_trying": 3.0})).drop("split")

    done = None
    for part in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(source)
        stream = tables.stream_table(spark, source, orders.schema)
        done = run_available(stream, transform, out, state)
    batch = transform(orders)
    assert done.count() == batch.count()
    assert done.exceptAll(batch).count() == 0 and batch.exceptAll(done).count() == 0


def test_template_takes_one_prediction_per_id(spark):
    from pyspark.errors import PySparkException

    from cohortlift.sources.sinks import fill_template

    template = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "id string, probability double")
    twice = spark.createDataFrame([("a", 0.2), ("a", 0.4), ("b", 2.0)], "id string, p double")
    assert sorted(map(tuple, fill_template(template, twice).collect())) == [("a", pytest.approx(0.3)), ("b", 1.0)]
    with pytest.raises(PySparkException, match="no prediction of id b"):
        fill_template(template, twice.where("id = 'a'")).collect()


def test_submission_keeps_the_order_of_the_template(spark):
    from pathlib import Path

    ids = [f"t{i * 7919 % 3001:05d}" for i in range(3001)]
    path = scratch_path(spark, "template")
    Path(path).mkdir()
    for part in range(3):  # the last files are the largest ones, which a scan reads first
        lines = ids[[0, 200, 900][part] : [200, 900, 3001][part]]
        Path(f"{path}/part-{part}.csv").write_text("ID,probability\n" + "".join(f"{i},0\n" for i in lines))
    preds = spark.createDataFrame([(i, int(i[1:]) / 3001) for i in sorted(ids)], "ID string, p double").repartition(5)
    template = sinks.read_template(spark, path, "ID string, probability double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out, stats = sinks.write_submission(template, preds, scratch_path(spark, "out"), 0.7, id="ID")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(Path(out).glob("part-*.csv"))
    rows = [line.split(",") for f in files for line in f.read_text().splitlines()[1:]]
    assert len(files) > 1 and [r[0] for r in rows] == ids and stats.first()["n"] == 3001
    assert [float(r[1]) for r in rows] == pytest.approx([int(i[1:]) / 3001 for i in ids])
    assert files[0].read_text().splitlines()[0] == "ID,probability"


def test_rejected_lines_have_reasons(spark):
    path = write_lines(spark, ["a,b,c", "1,2.5,x", "2,late,y", '3,1.0,"p, q"', "4,1.0", "5,1.0,z,more", '6,1.0,"open', "x,y,z", ",,"])
    schema = spark.createDataFrame([], "a bigint, b double, c string").schema
    good, bad = tables.split_rejected(spark, path, schema)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 2.5, "x"), (3, 1.0, "p, q"), (None, None, None)]
    found = {r["line"]: (r["reason"], r["columns"]) for r in bad.collect()}
    assert found == {
        "2,late,y": ("type", ["b"]), "4,1.0": ("width", None), "5,1.0,z,more": ("width", None), '6,1.0,"open': ("quotes", None), "x,y,z": ("type", ["a", "b"]),
    }
    assert all(r["file"].startswith("part-") for r in bad.collect())


@pytest.fixture(scope="module")
def saved(spark, small):
    from cohortlift.operators.models import ModelConfig
    from cohortlift.plans.base import split
    from cohortlift.streaming import state

    config = ModelConfig("s", ("embryos_total", "period_te", "TE__proc_age"), ("age_band",), "gbt", (42,), {"maxIter": 2, "maxDepth": 3})
    scorer = state.fit_scorer(split(spark, small)[0], config, k=2)
    root = scratch_path(spark, "scorer")
    return scorer, root, state.save(scorer, spark, root)


def test_scorer_keeps_only_the_columns_it_needs(spark, small, monkeypatch):
    from cohortlift import session
    from cohortlift.operators.models import ModelConfig
    from cohortlift.plans.base import split
    from cohortlift.streaming import state

    kept, write = {}, session.materialise

    def materialise(df, name, *rest):
        kept[name] = set(df.columns)
        return write(df, name, *rest)

    monkeypatch.setattr(session, "materialise", materialise)
    config = ModelConfig("s", ("embryos_total", "period_te"), ("age_band",), "forest", (42,), {"numTrees": 2, "maxDepth": 2})
    state.fit_scorer(split(spark, small)[0], config, k=2)
    assert kept["scorer-rows"] == {"id", S.TARGET, "embryos_total", "period_te", "age_band"}


def test_saved_scorer_equals_the_fitted_one(spark, small, saved):
    from cohortlift.plans.base import split
    from cohortlift.streaming import state

    scorer, root, version = saved
    test = split(spark, small)[1]
    back = state.load(spark, root)
    assert back.version == version and back.medians == dict(scorer.medians)
    a, b = scorer.score(test).drop("version"), back.score(test).drop("version")
    assert a.count() == test.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    newer = state.save(scorer, spark, root)
    assert state.load(spark, root).version == newer and state.load(spark, root, version).version == version
    with pytest.raises(FileNotFoundError):
        state.load(spark, scratch_path(spark, "nothing"))


def test_stream_that_restarts_scores_each_id_once(spark, small, saved):
    import shutil
    from pathlib import Path

    from cohortlift.plans.base import split
    from cohortlift.streaming import state

    scorer = state.load(spark, saved[1])
    test = split(spark, small)[1].drop("split").persist()
    source, path, checkpoint = (scratch_path(spark, n) for n in ("arriving", "scores", "state"))
    for part in (0, 1, 2):
        test.where(F.pmod("id", F.lit(3)) == part).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: tables.stream_table(spark, source, test.schema, max_files=1)
    state.score_stream(stream(), scorer, path, checkpoint).awaitTermination()
    assert len(list(Path(path).glob("batch=*"))) == 3
    Path(f"{checkpoint}/commits/.2.crc").unlink(missing_ok=True)
    Path(f"{checkpoint}/commits/2").unlink()  # the last batch was written, and the run was lost before it said so
    shutil.copytree(f"{path}/batch=2", f"{path}/batch=2/_kept")
    state.score_stream(stream(), scorer, path, checkpoint).awaitTermination()
    got = spark.read.parquet(path).drop("batch")
    want = scorer.score(test)
    assert got.count() == want.count() == got.select("id").distinct().count()
    assert got.exceptAll(want).count() == 0 and not Path(f"{path}/batch=2/_kept").exists()  # it was written again
