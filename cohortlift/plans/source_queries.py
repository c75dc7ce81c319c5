"""Queries through files: reads, submissions, exports, the prediction store and the file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.operators import encode as T
from cohortlift.operators.clean import clean
from cohortlift.operators.evaluate import auc
from cohortlift.operators.features import derive
from cohortlift.plans.base import cleaned, cycles, query, rounded, split, table, train_medians, with_cycles
from cohortlift.plans.evaluate_queries import _preds, keyed_rows, predictions
from cohortlift.plans.feature_queries import feature_sql, pick
from cohortlift.session import scratch_path
from cohortlift.sources import sinks
from cohortlift.sources.cycles import cycles_from
from cohortlift.sources.tables import conflicts, read_table, sample_schema, split_rejected, stream_table, to_headers
from cohortlift.operators.models import ModelConfig
from cohortlift.streaming import state
from cohortlift.streaming.score import run_available

ALL = [c.name for c in S.COLUMNS]
AS_READ = ", ".join(
    f"CAST({c.name} AS DOUBLE) AS {c.name}" if c.dtype == "double" else c.name for c in S.COLUMNS
)


def _as_csv(df, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    to_headers(df).write.option("header", True).csv(path)
    return path


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def read_parquet_with_schema(spark, sf_dir):
    schema = spark.createDataFrame(
        [], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    ).schema
    return read_table(spark, f"{sf_dir}/orders.parquet", schema)


@query(with_cycles(f"SELECT {AS_READ} FROM cycles"))
def read_csv_with_source_headers(spark, sf_dir):
    """The 69 columns written under their source headers and read back with the explicit schema."""
    path = _as_csv(cycles(spark, sf_dir).select(ALL), "cycles")
    return read_table(spark, path, fmt="csv", header="source")


@query(
    with_cycles(
        " UNION ALL ".join(
            f"SELECT '{c.name}' AS \"column\", CASE WHEN '{c.name}' = 'id' OR count(*) FILTER (WHERE {c.name} IS NOT NULL AND "
            f"TRY_CAST(CAST({c.name} AS VARCHAR) AS DOUBLE) IS NULL) > 0 THEN 'string' ELSE 'double' END AS type FROM cycles"
            for c in S.COLUMNS
        )
    )
)
def sampled_column_types(spark, sf_dir):
    """Types frozen from the first 200 lines of the file."""
    path = scratch_path(spark, "cycles")
    cycles(spark, sf_dir).select(ALL).write.option("header", True).csv(path)
    found = sample_schema(spark, path, 200)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "column string, type string")


@query(
    "SELECT 'o_orderkey' AS \"column\", 'double' AS type, 0 AS n_conflict UNION ALL "
    "SELECT 'o_orderpriority', 'string', 0 UNION ALL "
    "SELECT 'o_totalprice', 'double', count(*) FILTER (WHERE o_totalprice > 200000) FROM orders"
)
def late_type_conflicts(spark, sf_dir):
    """Values that do not fit the frozen types, counted over the whole file."""
    price = F.when(F.col("o_totalprice") > 200000, "high").otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", price.alias("o_totalprice"))
    path = _as_csv(rows, "orders")
    schema = spark.createDataFrame([], "o_orderkey double, o_orderpriority string, o_totalprice double").schema
    return conflicts(spark, path, schema)


@query(
    "SELECT o_orderkey, CASE o_orderkey % 97 WHEN 1 THEN 'width' WHEN 2 THEN 'width' WHEN 3 THEN 'type' WHEN 4 THEN 'quotes' ELSE 'good' END AS reason, "
    "CASE WHEN o_orderkey % 97 = 3 THEN 'o_totalprice' END AS columns, CASE WHEN o_orderkey % 97 BETWEEN 1 AND 4 THEN NULL ELSE o_totalprice END AS price "
    "FROM orders"
)
def rejected_lines(spark, sf_dir):
    """Lines of a wrong width, with late text in a number column or with an open quote, told from the rows that fit."""
    n = F.col("o_orderkey") % 97
    parts = [F.col("o_orderkey").cast("string"), F.when(n == 3, "late").otherwise(F.col("o_totalprice").cast("string"))]
    last = F.when(n == 4, F.concat(F.lit('"'), F.col("o_orderpriority"))).otherwise(F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', x"')))
    whole = F.concat_ws(",", *parts, last)
    line = F.when(n == 1, F.concat_ws(",", *parts)).when(n == 2, F.concat_ws(",", whole, F.lit("more"))).otherwise(whole)
    path = scratch_path(spark, "lines")
    # The header option drops the first line of each file, so every part gets one.
    rows = table(spark, sf_dir, "orders").select(F.spark_partition_id().alias("part"), line.alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit("o_orderkey,o_totalprice,priority").alias("value"), F.lit(0).alias("at"))
    both = heads.unionByName(rows.withColumn("at", F.lit(1))).repartition("part").sortWithinPartitions("part", "at")
    both.select("part", "value").write.partitionBy("part").text(path)
    schema = spark.createDataFrame([], "o_orderkey bigint, o_totalprice double, priority string").schema
    good, bad = split_rejected(spark, f"{path}/*", schema)
    key = F.split("line", ",")[0].cast("bigint")
    return good.select("o_orderkey", F.lit("good").alias("reason"), F.lit(None).cast("string").alias("columns"), F.col("o_totalprice").alias("price")).unionByName(
        bad.select(key.alias("o_orderkey"), "reason", F.array_join("columns", ",").alias("columns"), F.lit(None).cast("double").alias("price"))
    )


PART = ["past_preg_rate", "past_birth_rate", "ivf_preg_rate", "embryo_transfer_ratio", "embryo_stored_ratio", "icsi_ratio",
        "age_x_transferred", "gap_transfer_minus_pickup"]


@query(feature_sql("raw", PART))
def row_local_features_from_csv(spark, sf_dir):
    """A partitioned read with row-local work gives what one whole read gives."""
    path = _as_csv(cycles(spark, sf_dir).select(ALL), "cycles")
    rows = read_table(spark, path, fmt="csv", header="source")
    return pick(derive(clean(rows, "raw"), "base", "raw"), PART)


def _scores(spark, sf_dir):
    """The encoded probability of the test rows, and its area over the train rows."""
    train, test = (keyed_rows(side) for side in split(spark, sf_dir))
    encoder = T.fit_encoder(train.withColumn("fold", F.lit(0)), {"p": T.Key("k_type_age", 25.0)})
    seen = encoder.transform(train).select(F.col(S.TARGET).cast("double").alias("y"), "p")
    return encoder.transform(test), auc(seen).first()["auc"]


SCORES_SQL = [
    "k AS (SELECT treatment_type, age_band, count(*) AS n, sum(success) AS t FROM cycles WHERE split = 'train' GROUP BY 1, 2)",
    "g AS (SELECT CAST(sum(t) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS gm FROM k)",
    "scores AS (SELECT c.id, least(greatest(coalesce((CAST(k.t AS DOUBLE) + g.gm * 25.0) / (CAST(k.n AS DOUBLE) + 25.0), "
    "g.gm), 0), 1) AS probability FROM cycles c LEFT JOIN k ON k.treatment_type = c.treatment_type AND "
    "k.age_band = c.age_band CROSS JOIN g WHERE c.split = 'test')",
]


def _submit(spark, sf_dir):
    scores, area = _scores(spark, sf_dir)
    template = split(spark, sf_dir)[1].select("id", F.lit(0.0).alias("probability"))
    return sinks.write_submission(template, scores, scratch_path(spark, "submission"), area, "encoding")


@query(with_cycles("SELECT id, probability FROM scores", *SCORES_SQL))
def submission_file(spark, sf_dir):
    """The template filled with clipped predictions, as read back from the CSV."""
    path, _ = _submit(spark, sf_dir)
    return spark.read.schema("id bigint, probability double").option("header", True).csv(path)


@query(
    with_cycles(
        "SELECT count(*) AS n, round(avg(probability), 9) AS mean_p, round(stddev_samp(probability), 9) AS std_p FROM scores",
        *SCORES_SQL,
    )
)
def submission_summary(spark, sf_dir):
    return _submit(spark, sf_dir)[1].select("n", rounded("mean_p"), rounded("std_p"))


@query(
    _preds(
        "SELECT 'oof' AS part, id, y, model, seed, fold, p FROM preds UNION ALL SELECT 'test', id, NULL, 'type_age', -1, -1, probability FROM scores",
        *SCORES_SQL,
    )
)
def stored_predictions(spark, sf_dir):
    """Train and test predictions written under the fingerprint of their rows, loaded, and written again on request."""
    root, rows = scratch_path(spark, "store"), predictions(spark, sf_dir)
    test = _scores(spark, sf_dir)[0].select(
        "id", F.lit(None).cast("int").alias("y"), F.lit("type_age").alias("model"), F.lit(-1).alias("seed"), F.lit(-1).alias("fold"), "p"
    )
    parts = {"oof": rows, "test": test}
    config = {"rows": sinks.fingerprint(split(spark, sf_dir)[0]), "members": ["type_age", "period", "procedure"], "seeds": [42, 2024]}
    sinks.stored(spark, root, config, lambda: parts)
    out = sinks.stored(spark, root, config, lambda: parts, recompute=True)
    both = [out[p].select(F.lit(p).alias("part"), "id", F.col("y").cast("int").alias("y"), "model", "seed", "fold", "p") for p in parts]
    return both[0].unionByName(both[1])


V3_PART = ["embryo_transfer_ratio", "age_x_embryo_ratio", "real_age_num", "age_normalized_pipeline", "has_ICSI"]


@query(feature_sql("clean", V3_PART, ", success, split"))
def exported_feature_table(spark, sf_dir):
    """The v3 feature table with its target, written and read back."""
    path = scratch_path(spark, "features")
    sinks.write_features(derive(cleaned(spark, sf_dir), "v3"), path)
    return spark.read.parquet(path).select("id", *V3_PART, "success", "split")


STREAM_PART = ["past_preg_rate", "days_mix_to_transfer", "age_normalized_pipeline", "embryo_group", "eset_blast",
               "ratio_icsi_success"]


@query(feature_sql("clean", STREAM_PART))
def streamed_features(spark, sf_dir):
    """Orders arrive as a file stream; cleaning with saved medians and derivation give what the batch gives."""
    medians = train_medians(cycles(spark, sf_dir))
    schema = table(spark, sf_dir, "orders").schema
    stream = stream_table(spark, sf_dir, schema, glob="orders.parquet")

    def transform(df):
        return derive(clean(cycles_from(df), "clean", medians)).select("id", *STREAM_PART)

    return run_available(stream, transform, scratch_path(spark, "stream"), scratch_path(spark, "stream-state"))


@query(
    with_cycles(
        "SELECT id, success, "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}__isnan" for c in S.MISSING_FLAGS)
        + " FROM cycles"
    )
)
def streamed_missing_flags(spark, sf_dir):
    """The raw profile on the stream."""
    schema = table(spark, sf_dir, "orders").schema
    stream = stream_table(spark, sf_dir, schema, glob="orders.parquet", max_files=1)

    def transform(df):
        return clean(cycles_from(df), "raw").select("id", "success", *[f"{c}__isnan" for c in S.MISSING_FLAGS])

    return run_available(stream, transform, scratch_path(spark, "stream"), scratch_path(spark, "stream-state"))


def _key_sql(name: str, key: str, strength: float) -> str:
    return (
        f"{name} AS (SELECT k_, (CAST(t AS DOUBLE) + g.gm * {strength}) / (CAST(n AS DOUBLE) + {strength}) AS te FROM "
        f"(SELECT {key} AS k_, count(*) AS n, sum(success) AS t FROM train GROUP BY 1) CROSS JOIN g WHERE k_ IS NOT NULL)"
    )


TYPE_AGE_SQL = "concat(coalesce(treatment_type, 'nan'), '_', coalesce(age_band, 'nan'))"


@query(
    with_cycles(
        "SELECT c.id, round(coalesce(p.te, g.gm), 9) AS period_te, round(coalesce(a.te, g.gm), 9) AS type_age_te, 1 AS is_probability, 1 AS n FROM cycles c "
        f"LEFT JOIN p ON p.k_ = c.period_code LEFT JOIN a ON a.k_ = {TYPE_AGE_SQL.replace('treatment_type', 'c.treatment_type').replace('age_band', 'c.age_band')} "
        "CROSS JOIN g WHERE c.split = 'test'",
        "train AS (SELECT * FROM cycles WHERE split = 'train')",
        "g AS (SELECT CAST(sum(success) AS DOUBLE) / count(*) AS gm FROM train)",
        _key_sql("p", "period_code", 20.0),
        _key_sql("a", TYPE_AGE_SQL, 25.0),
    )
)
def streamed_scores(spark, sf_dir):
    """Test rows that arrive as files, encoded and scored from a saved scorer; the last files' batch runs twice, as after a
    lost run, and leaves no id twice."""
    train, _ = split(spark, sf_dir)
    config = ModelConfig("stream", ("embryos_total", "day_transfer", "age_median", "n_missing_row", "period_te", "TE__proc_age"), ("age_band", "egg_source"), "forest")
    root = scratch_path(spark, "scorer")
    state.save(state.fit_scorer(train, config), spark, root)
    scorer = state.load(spark, root)
    orders = table(spark, sf_dir, "orders")
    source, path, checkpoint = (scratch_path(spark, n) for n in ("arriving", "scores", "scores-state"))

    def test_rows(df):
        return cycles_from(df).where("split = 'test'").drop("split", S.TARGET)

    for part in (0, 1):
        orders.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == part).write.mode("append").parquet(source)
        stream = stream_table(spark, source, orders.schema)
        state.score_stream(stream, scorer, path, checkpoint, test_rows).awaitTermination()
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/1")
    files.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(files, False)
    state.score_stream(stream_table(spark, source, orders.schema), scorer, path, checkpoint, test_rows).awaitTermination()
    found = spark.read.parquet(path)
    return found.groupBy("id").agg(
        F.round(F.max("period_te"), 9).alias("period_te"), F.round(F.max("TE__proc_age"), 9).alias("type_age_te"),
        F.bool_and(F.col("p").between(0, 1)).cast("int").alias("is_probability"), F.count("*").cast("int").alias("n"),
    )
