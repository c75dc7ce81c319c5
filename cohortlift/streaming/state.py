"""A fitted scorer as a versioned artefact that batch and stream load: medians, encoder counts, category indexers, models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlift import schema as S
from cohortlift.functions.joins import by_id
from cohortlift.operators import encode as T
from cohortlift.operators import models as G
from cohortlift.operators.clean import clean
from cohortlift.operators.features import derive

FORMAT = 1
_LOADERS = {c.__name__: c for c in (GBTClassificationModel, RandomForestClassificationModel, LogisticRegressionModel)}


@dataclass(frozen=True)
class Scorer:
    """All fitted state between a raw row and its probability (clean profile)."""

    medians: Mapping[str, float]
    encoder: T.Encoder
    vectors: G.Vectors
    models: Mapping[tuple[int, int], object]
    version: str = ""

    def features(self, raw: DataFrame) -> DataFrame:
        """Cleaned, derived and encoded rows."""
        rows = T.combo_keys(derive(clean(raw, "clean", dict(self.medians))), "age_ord")
        return self.encoder.transform(rows).drop(*[k.column for k in self.encoder.keys.values() if k.column.startswith("proc_")])

    def score(self, raw: DataFrame) -> DataFrame:
        """``(id, encodings..., p, version)``, a row per row: the mean probability of all models."""
        names = list(self.encoder.keys)
        rows = self.features(raw).withColumn("_label", F.lit(None).cast("double"))
        out, parts = G._score_all(self.models, self.vectors.transform(rows, "_label", names), False)
        return out.select("id", *names, (reduce(add, parts) / F.lit(float(len(parts)))).alias("p"), F.lit(self.version).alias("version"))


def _lines(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def save(scorer: Scorer, spark: SparkSession, root: str) -> str:
    """Write a new version under ``root`` and make it the current one last; returns its name."""
    version = uuid.uuid4().hex
    path = f"{root}/{version}"
    scorer.encoder.stats.write.parquet(f"{path}/counts")
    v = scorer.vectors
    if v.indexer is not None:
        v.indexer.write().save(f"{path}/indexer")
    if v.vocab is not None:
        v.vocab.write.parquet(f"{path}/vocabulary")
    models = []
    for i, ((seed, fold), model) in enumerate(scorer.models.items()):
        model.write().save(f"{path}/model-{i}")
        models.append([seed, fold, type(model).__name__])
    e = scorer.encoder
    body = {
        "format": FORMAT,
        "medians": dict(scorer.medians),
        "keys": {n: [k.column, k.smoothing] for n, k in e.keys.items()},
        "k": e.k, "fold_prior": {str(f): p for f, p in e.fold_prior.items()}, "prior": e.prior, "size": e.size,
        "vectors": {
            "features": v.features, "flagged": v.flagged, "categories": v.categories, "fill": v.fill, "max_bins": v.max_bins, "wide": v.wide,
            "indexer": v.indexer is not None, "vocab": v.vocab is not None,
        },
        "models": models,
    }
    _lines(spark, f"{path}/state", json.dumps(body))
    _lines(spark, f"{root}/current", version)
    return version


def load(spark: SparkSession, root: str, version: str | None = None) -> Scorer:
    """The current version, or a named one.  A format this code does not know is refused."""
    try:
        version = version or spark.read.text(f"{root}/current").first()[0]
        path = f"{root}/{version}"
        body = json.loads(spark.read.text(f"{path}/state").first()[0])
    except AnalysisException as missing:
        raise FileNotFoundError(f"no saved scorer under {root}") from missing
    if body["format"] != FORMAT:
        raise ValueError(f"saved scorer has format {body['format']}, not {FORMAT}")
    keys = {n: T.Key(c, s) for n, (c, s) in body["keys"].items()}
    priors = {int(f): p for f, p in body["fold_prior"].items()}
    encoder = T.Encoder(keys, body["k"], spark.read.parquet(f"{path}/counts"), priors, body["prior"], body["size"])
    v = body["vectors"]
    vectors = G.Vectors(
        tuple(v["features"]), tuple(v["flagged"]), StringIndexerModel.load(f"{path}/indexer") if v["indexer"] else None, tuple(v["categories"]),
        v["fill"], v["max_bins"], tuple(v["wide"]), spark.read.parquet(f"{path}/vocabulary") if v["vocab"] else None,
    )
    models = {(s, f): _LOADERS[kind].load(f"{path}/model-{i}") for i, (s, f, kind) in enumerate(body["models"])}
    return Scorer(body["medians"], encoder, vectors, models, version)


def fit_scorer(train: DataFrame, config: G.ModelConfig, keys: Mapping[str, T.Key] | None = None, k: int = S.N_FOLDS, threads: int = 8) -> Scorer:
    """Fit all state on labelled raw rows: medians, encodings (out of fold for training), indexers and a model per seed and fold."""
    from cohortlift.operators.fit import as_dict, fit_medians
    from cohortlift.operators.folds import fold_column, fold_columns
    from cohortlift.session import materialise

    keys = keys or {**T.PERIOD_KEY, **T.COMBO_KEYS}
    medians = as_dict(fit_medians(train))
    rows = T.combo_keys(derive(clean(train, "clean", medians)), "age_ord")
    columns = list(dict.fromkeys(key.column for key in keys.values()))
    # Of the wide rows only what the models and the encoder read is computed, once, and written.
    wanted = list(dict.fromkeys(c for c in (*config.features, *config.categories) if c not in keys))
    rows = materialise(rows.select(*dict.fromkeys(["id", S.TARGET, *columns, *wanted])), "scorer-columns")
    narrow = rows.select("id", S.TARGET, *columns)
    folds = materialise(by_id(narrow, fold_columns(narrow, k=k).withColumnRenamed(fold_column(42), "fold")), "scorer-folds")
    encoder = T.fit_encoder(folds, keys, k=k)
    used = [c for c in keys if c in config.features]
    rows = materialise(by_id(rows.select("id", S.TARGET, *wanted), encoder.oof(folds).select("id", *used)), "scorer-rows")
    fitted = G.cross_fit(rows, rows.limit(0), config, k, threads=threads)
    return Scorer(medians, encoder, fitted.vectors, fitted.models)


def score_stream(source: DataFrame, scorer: Scorer, path: str, checkpoint: str, prepare=None) -> StreamingQuery:
    """Score what has arrived, then stop.  A micro-batch is written under its number, in place of what a lost run left there, so
    a batch that runs again leaves no row twice."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        scorer.score(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
