"""Cross-fitted learners on Spark ML.

Predictions are long tables ``id, y, model, seed, fold, p``; rows are matched by id, never by position.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlift import schema as S
from cohortlift.functions import scalars as X
from cohortlift.functions.joins import by_id
from cohortlift.operators.evaluate import auc
from cohortlift.operators.fit import apply_vocab, fit_vocab
from cohortlift.operators.folds import assign_folds, fold_column, fold_columns, split_fold
from cohortlift.session import materialise, shared_dir

INDEXED_VALUES = 1000  # a tree splits a category of so many values by groups of values, a wider one by its code
PREDICTION = ("id", "y", "model", "seed", "fold", "p")
BOOSTED = ("gbt", "gbt_deep", "residual")
ROWS_PER_TASK = 20_000  # a fit spreads over a task for so many rows, up to its share of the cores; fits run side by side
MOST_ROWS_PER_TASK = 200_000  # beyond so many rows a fit takes more tasks than its share of the cores
FITS_AT_ONCE = 2  # the driver holds the running jobs of so many fits at most


@dataclass(frozen=True)
class ModelConfig:
    """One ensemble member: features, learner, seeds and learner settings."""

    name: str
    features: tuple[str, ...]
    categories: tuple[str, ...] = ()
    learner: str = "gbt"
    seeds: tuple[int, ...] = (42,)
    params: Mapping[str, object] = field(default_factory=dict)


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


@dataclass(frozen=True)
class Vectors:
    """Fitted vector stage: which numbers need a missing flag, and the category indexers."""

    features: tuple[str, ...]
    flagged: tuple[str, ...]
    indexer: StringIndexerModel | None
    categories: tuple[str, ...]
    fill: float
    max_bins: int
    wide: tuple[str, ...] = ()
    vocab: DataFrame | None = None

    def transform(self, df: DataFrame, label: str, carry: Sequence[str] = ()) -> DataFrame:
        def number(c: str) -> str:
            return f"nanvl(try_cast(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))"

        out = df.selectExpr(
            "id",
            f"CAST({label} AS DOUBLE) AS y",
            *carry,
            *[f"coalesce({number(c)}, {self.fill}D) AS `_x_{c}`" for c in self.features],
            *[f"CAST({number(c)} IS NULL AS INT) AS `_m_{c}`" for c in self.flagged],
            *[f"coalesce(CASE WHEN `{c}` NOT IN ('nan', 'None') THEN `{c}` END, 'NaN') AS `_t_{c}`" for c in (*self.categories, *self.wide)],
        )
        inputs = [f"_x_{c}" for c in self.features] + [f"_m_{c}" for c in self.flagged]
        if self.indexer is not None:
            out = self.indexer.transform(out)
            inputs += [f"_i_{c}" for c in self.categories]
        if self.vocab is not None:
            texts = [f"_t_{c}" for c in self.wide]
            out = apply_vocab(out, self.vocab, texts, "NaN", unseen="keep")
            out = out.select("*", *[F.col(f"{t}_code").cast("double").alias(f"{t}_number") for t in texts])
            inputs += [f"{t}_number" for t in texts]
        out = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error").transform(out)
        return out.select("id", "y", *carry, "features")


def fit_vectors(train: DataFrame, config: ModelConfig) -> Vectors:
    """Find the features that can be missing and index the categories, from train rows."""
    missing = train.selectExpr(*[f"coalesce(bool_or(`{c}` IS NULL OR isnan(try_cast(`{c}` AS DOUBLE))), false) AS `{c}`" for c in config.features]).first()
    flagged = tuple(c for c in config.features if missing[c])
    texts = {c: X.text_or(c, "NaN").alias(f"_t_{c}") for c in config.categories}
    sizes = train.select(*[F.count_distinct(t).alias(c) for c, t in texts.items()]).first() if texts else {}
    # A category of many values is one ordered code, as in the reference's tables; its codes are dealt by Spark.
    wide = tuple(c for c in texts if sizes[c] > INDEXED_VALUES)
    cats = tuple(c for c in texts if c not in wide)
    indexer = vocab = None
    if cats:
        indexer = StringIndexer(
            inputCols=[f"_t_{c}" for c in cats],
            outputCols=[f"_i_{c}" for c in cats],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(train.select(*[texts[c] for c in cats]))
    if wide:
        vocab = fit_vocab(train.select(*[texts[c] for c in wide]), [f"_t_{c}" for c in wide], placeholder="NaN")
    max_bins = max(32, max((len(a) for a in indexer.labelsArray), default=0) + 2 if indexer else 0)
    fill = 0.0 if config.learner == "logistic" else -999.0
    return Vectors(config.features, flagged, indexer, cats, fill, max_bins, wide, vocab)


# Settings that follow the reference learners; rounds are small by default and a parameter.
LEARNERS: dict[str, tuple[Callable, dict[str, object]]] = {
    "gbt": (
        GBTClassifier,
        dict(maxIter=20, maxDepth=6, stepSize=0.1, subsamplingRate=0.85, featureSubsetStrategy="0.8", minInstancesPerNode=150),
    ),
    "gbt_deep": (
        GBTClassifier,
        dict(maxIter=20, maxDepth=7, stepSize=0.1, subsamplingRate=0.85, featureSubsetStrategy="0.8", minInstancesPerNode=10),
    ),
    "forest": (
        RandomForestClassifier,
        dict(numTrees=40, maxDepth=6, subsamplingRate=0.7, featureSubsetStrategy="0.7", minInstancesPerNode=20),
    ),
    "logistic": (LogisticRegression, dict(maxIter=50, regParam=0.001, standardization=True)),
    "residual": (
        GBTRegressor,
        dict(maxIter=20, maxDepth=6, stepSize=0.03, subsamplingRate=0.7, featureSubsetStrategy="0.7", minInstancesPerNode=150),
    ),
}


def make_learner(config: ModelConfig, vectors: Vectors, seed: int):
    build, defaults = LEARNERS[config.learner]
    params = {**defaults, **config.params}
    if config.learner != "logistic":
        # Shallow trees find a row's node sooner than a table of nodes is written and joined at every level.
        params.update(seed=seed, maxBins=vectors.max_bins, cacheNodeIds=False, checkpointInterval=10)
    return build(featuresCol="features", labelCol="y", **params)


def best_prefix(losses: Sequence[float], patience: int | None = None) -> int:
    """Rounds up to the smallest loss; looking ends ``patience`` rounds after the best one so far."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif patience is not None and i - best >= patience:
            break
    return best + 1


def truncated(model, rounds: int):
    """The boosted model of the first ``rounds`` trees: what a fit of so many rounds gives, without that fit."""
    trees, weights = list(model._java_obj.trees())[:rounds], list(model._java_obj.treeWeights())[:rounds]
    gateway = SparkSession.active().sparkContext._gateway
    jvm = gateway.jvm.org.apache.spark.ml
    tree_array = gateway.new_array(jvm.regression.DecisionTreeRegressionModel, len(trees))
    weight_array = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        tree_array[i], weight_array[i] = tree, weight
    if isinstance(model, GBTClassificationModel):
        shorter = GBTClassificationModel(jvm.classification.GBTClassificationModel(model.uid, tree_array, weight_array))
    else:
        shorter = GBTRegressionModel(jvm.regression.GBTRegressionModel(model.uid, tree_array, weight_array))
    return model._copyValues(shorter)


def stopped(model, valid: DataFrame, patience: int):
    """The boosted model cut where the loss on ``valid`` is smallest, from one pass over ``valid``."""
    losses = model.evaluateEachIteration(valid) if isinstance(model, GBTClassificationModel) else model.evaluateEachIteration(valid, "squared")
    rounds = best_prefix(losses, patience)
    return truncated(model, rounds) if rounds < len(losses) else model


def in_parallel(df: DataFrame, tasks: Sequence[Callable[[], object]], threads: int) -> list:
    """Run independent fits from a few driver threads; each fit stays distributed.

    Each task gets a copy of the local properties of its own: Spark notes the running SQL execution in them.
    """
    if threads <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    wrapped = [inheritable_thread_target(df.sparkSession)(task) for task in tasks]
    with ThreadPool(min(threads, len(tasks))) as pool:
        return pool.map(lambda task: task(), wrapped, chunksize=1)


def fit_tasks(df: DataFrame, rows: int) -> int:
    """Tasks of a fit over ``rows``: a level of a tree is a job, so a fit takes no more of them than run at once beside the others."""
    share = -(-df.sparkSession.sparkContext.defaultParallelism // FITS_AT_ONCE)
    return max(1, min(-(-rows // ROWS_PER_TASK), share), -(-rows // MOST_ROWS_PER_TASK))


def at_once(df: DataFrame, threads: int, tasks: int) -> int:
    """How many fits of ``tasks`` tasks run side by side: as many as keep the cores busy, within ``FITS_AT_ONCE``."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(threads, FITS_AT_ONCE, -(-slots // tasks)))


def _score(model, rows: DataFrame, regression: bool) -> DataFrame:
    scored = model.transform(rows)
    p = F.col("prediction") if regression else vector_to_array("probability")[1]
    return scored.withColumn("p", p)


def _score_all(models: Mapping[tuple[int, int], object], rows: DataFrame, regression: bool) -> tuple[DataFrame, list]:
    """``rows`` with a prediction of every model, from one scan, and the columns that hold them."""
    out, parts = rows, []
    for i, model in enumerate(models.values()):
        model = model.copy()
        model.setPredictionCol(f"_prediction{i}")
        if not regression:
            model.setProbabilityCol(f"_probability{i}").setRawPredictionCol(f"_raw{i}")
        out = model.transform(out)
        parts.append(F.col(f"_prediction{i}") if regression else vector_to_array(f"_probability{i}")[1])
    return out, parts


@dataclass(frozen=True)
class Fitted:
    """A cross-fitted member: its models by seed and fold, its stored rows, and what they predict."""

    config: ModelConfig
    vectors: Vectors
    models: Mapping[tuple[int, int], object]
    rows: DataFrame
    ahead: DataFrame
    carry: tuple[str, ...] = ()

    @property
    def regression(self) -> bool:
        return self.config.learner == "residual"

    def _named(self, df: DataFrame) -> DataFrame:
        return df.withColumn("model", F.lit(self.config.name)).select(*PREDICTION, *self.carry)

    def oof(self) -> DataFrame:
        """Every train row once per seed, by the model that has not seen it."""

        def part(seed: int, fold: int) -> DataFrame:
            own = _score(self.models[seed, fold], self.rows.where(F.col(fold_column(seed)) == fold), self.regression)
            return self._named(own.withColumn("seed", F.lit(seed)).withColumn("fold", F.lit(fold)))

        return union([part(s, f) for s, f in self.models])

    def score(self, rows: DataFrame) -> DataFrame:
        """``(id, y, p)`` of rows with features: the running mean of all models, a row per row."""
        out, parts = _score_all(self.models, rows, self.regression)
        return out.select("id", "y", *self.carry, (reduce(add, parts) / F.lit(float(len(parts)))).alias("p"))

    def test(self) -> DataFrame:
        """The test rows, once each (seed and fold are -1): the mean over seeds and folds."""
        return self._named(self.score(self.ahead).withColumn("seed", F.lit(-1)).withColumn("fold", F.lit(-1)))

    def test_by_model(self) -> DataFrame:
        """The test rows once per seed and fold, for those who look at single models."""
        out, parts = _score_all(self.models, self.ahead, self.regression)
        each = [F.struct(F.lit(s).alias("seed"), F.lit(f).alias("fold"), p.alias("p")) for (s, f), p in zip(self.models, parts)]
        return self._named(out.select("id", "y", *self.carry, F.inline(F.array(*each))))

    def rounds(self) -> list[tuple[str, int, int, int]]:
        """(model, seed, fold, trees) of each fitted ensemble; 0 where there are no trees."""
        return [(self.config.name, s, f, int(getattr(m, "getNumTrees", 0))) for (s, f), m in self.models.items()]


def cross_fit(
    train: DataFrame,
    test: DataFrame,
    config: ModelConfig,
    k: int = S.N_FOLDS,
    label: str = S.TARGET,
    threads: int = 4,
    patience: int | None = None,
    stratify: str | None = None,
    carry: Sequence[str] = (),
) -> Fitted:
    """Fit a member's models, one per seed and fold; the rows are written once, with a fold column per seed.

    With ``patience`` a boosted model keeps the trees up to the smallest loss on its validation fold, and the learner's
    rounds are an upper limit.  Folds are stratified by ``stratify`` (the label).  ``carry`` names columns of both sides
    that come back with the predictions.
    """
    shared_dir(train.sparkSession)
    vectors = fit_vectors(train, config)
    kept = list(dict.fromkeys([*carry, *([stratify] if stratify else [])]))
    rows = vectors.transform(train, label, kept)
    dealt = fold_columns(train.select("id", F.col(stratify or label).alias("_class")), "id", "_class", k, config.seeds)
    rows = materialise(by_id(rows, dealt), f"train-{config.name}")
    for c in (label, *carry):
        if c not in test.columns:
            test = test.withColumn(c, F.lit(None).cast("double"))
    ahead = vectors.transform(test, label, carry)
    tasks = fit_tasks(train, rows.count())

    def fit(seed: int, fold: int):
        part, valid = split_fold(rows.select("id", "y", "features", fold_column(seed)), fold, fold_column(seed))
        model = make_learner(config, vectors, seed).fit(part.coalesce(tasks))
        if patience is not None and config.learner in BOOSTED:
            model = stopped(model, valid.coalesce(tasks), patience)
        return (seed, fold), model

    jobs = [(s, f) for s in config.seeds for f in range(k)]
    models = dict(in_parallel(train, [lambda s=s, f=f: fit(s, f) for s, f in jobs], at_once(train, threads, tasks)))
    return Fitted(config, vectors, models, rows, ahead, tuple(carry))


def train_oof(
    train: DataFrame,
    test: DataFrame,
    config: ModelConfig,
    k: int = S.N_FOLDS,
    label: str = S.TARGET,
    threads: int = 4,
    patience: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Long out-of-fold predictions, and the test rows once per seed and fold, of ``cross_fit``."""
    fitted = cross_fit(train, test, config, k, label, threads, patience)
    return fitted.oof(), fitted.test_by_model()


def fit_segments(
    train: DataFrame,
    test: DataFrame,
    segment: str,
    configs: Mapping[object, ModelConfig],
    k: int = S.N_FOLDS,
    label: str = S.TARGET,
    threads: int = 4,
    patience: int | None = None,
) -> list[Fitted]:
    """One member per segment value, each with its own folds; the parts together cover every row once per seed.

    A row whose segment is NULL or has no member is refused, as no part would cover it.
    """
    covered = F.coalesce(F.col(segment).isin(list(configs)), F.lit(False))
    lost = train.select(segment).unionByName(test.select(segment)).where(~covered).count()
    if lost:
        raise ValueError(f"{lost} rows have no member for their {segment}")
    parts = []
    for v, c in configs.items():
        own = [side.where(F.col(segment) == v) for side in (train, test)]
        parts.append(cross_fit(*own, c, k, label, threads, patience))
    return parts


def train_by_segment(
    train: DataFrame,
    test: DataFrame,
    segment: str,
    configs: Mapping[object, ModelConfig],
    k: int = S.N_FOLDS,
    label: str = S.TARGET,
    threads: int = 4,
    patience: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Long predictions of ``fit_segments``, as ``train_oof`` gives them."""
    parts = fit_segments(train, test, segment, configs, k, label, threads, patience)
    return union([p.oof() for p in parts]), union([p.test_by_model() for p in parts])


def train_residual(
    train: DataFrame,
    test: DataFrame,
    base_oof: DataFrame,
    base_pred: DataFrame,
    config: ModelConfig,
    k: int = S.N_FOLDS,
    label: str = S.TARGET,
    threads: int = 4,
    patience: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Regress what the base prediction ``(id, p)`` leaves over, add it back and clip to [0, 1].

    Folds are stratified by the label, not by the residual.  A test row takes the mean residual of the models (its seed and
    fold are -1) and is clipped after that.  Base and label travel with the rows.
    """
    based = by_id(train, base_oof.select("id", F.col("p").alias("_base")))
    based = based.withColumn("_residual", F.col(label) - F.col("_base")).withColumn("_truth", F.col(label).cast("double"))
    ahead = by_id(test, base_pred.select("id", F.col("p").alias("_base")))
    fitted = cross_fit(based, ahead, config, k, "_residual", threads, patience, "_truth", ("_base", "_truth"))

    def corrected(parts: DataFrame) -> DataFrame:
        fixed = parts.withColumn("p", X.clip01(F.col("_base") + F.col("p"))).withColumn("y", F.col("_truth"))
        return fixed.select(*PREDICTION)

    return corrected(fitted.oof()), corrected(fitted.test())


def stack(
    wide: DataFrame,
    test_wide: DataFrame,
    members: Sequence[str],
    cs: Sequence[float] = (0.01, 0.1, 1.0, 10.0),
    k: int = S.N_FOLDS,
    seed: int = 42,
    threads: int = 4,
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Logistic stack over member columns of ``(id, y, members...)``.

    The strength C is chosen by cross-validated AUC on stratified folds.  Returns ``(id, y, p)`` predicted by
    the folds that did not see the row, ``(id, p)`` of the test rows, and the chosen C with both AUCs.
    """
    assembler = VectorAssembler(inputCols=list(members), outputCol="features")
    rows = assign_folds(assembler.transform(wide).select("id", F.col("y").cast("double").alias("y"), "features"), "id", "y", k, (seed,))
    rows = materialise(rows, "stack")
    n = rows.count()
    base = LogisticRegression(featuresCol="features", labelCol="y", maxIter=1000, standardization=False)
    grid = ParamGridBuilder().addGrid(base.regParam, [1.0 / (c * n) for c in cs]).build()
    evaluator = BinaryClassificationEvaluator(labelCol="y", metricName="areaUnderROC", numBins=0)
    search = CrossValidator(
        estimator=base, estimatorParamMaps=grid, evaluator=evaluator, numFolds=k, foldCol="fold", parallelism=threads
    ).fit(rows)
    top = max(range(len(cs)), key=search.avgMetrics.__getitem__)
    whole = search.bestModel
    chosen = base.copy({base.regParam: 1.0 / (cs[top] * n)})

    def one(fold: int) -> DataFrame:
        part, valid = split_fold(rows, fold)
        return _score(chosen.fit(part), valid, False).select("id", "y", "p")

    nested = union(in_parallel(rows, [lambda f=f: one(f) for f in range(k)], threads))
    inside = _score(whole, rows, False).select("id", "y", "p")
    ahead = _score(whole, assembler.transform(test_wide), False).select("id", "p")
    scores = {
        "c": cs[top],
        "in_sample_auc": auc(inside).first()["auc"],
        "nested_auc": auc(nested).first()["auc"],
    }
    return nested, ahead, scores


@dataclass(frozen=True)
class Candidate:
    """A learner with settings that takes part in a choice."""

    learner: str
    params: tuple[tuple[str, object], ...] = ()

    @property
    def name(self) -> str:
        return " ".join([self.learner, *[f"{k}={v}" for k, v in self.params]])


CANDIDATES = (
    Candidate("gbt"),
    Candidate("gbt", (("maxDepth", 4),)),
    Candidate("gbt_deep"),
    Candidate("forest"),
    Candidate("forest", (("maxDepth", 9),)),
    Candidate("logistic"),
    Candidate("logistic", (("regParam", 0.01), ("elasticNetParam", 0.5))),
)


def share_of(id: Column, seed: int = 42) -> Column:
    """A number in [0, 1) by md5 of "id:seed:share", the same in every engine that has md5."""
    text = F.md5(F.concat_ws(":", id.cast("string"), F.lit(str(seed)), F.lit("share")))
    return F.conv(F.substring(text, 1, 6), 16, 10).cast("double") / float(1 << 24)


def rungs(candidates: int, eta: int, least: int = 1) -> list[tuple[float, int]]:
    """(share of the rows, candidates that take part) of successive halving; the last rung has all rows."""
    counts = [candidates]
    while counts[-1] > least and counts[-1] > 1:
        counts.append(max(least, -(-counts[-1] // eta)))
    return [(float(eta) ** (i + 1 - len(counts)), n) for i, n in enumerate(counts)]


def select_learner(
    train: DataFrame,
    test: DataFrame,
    config: ModelConfig,
    candidates: Sequence[Candidate] = CANDIDATES,
    eta: int = 3,
    k: int = 3,
    label: str = S.TARGET,
    threads: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Successive halving: all candidates on a small share of the rows, the best 1/``eta`` of them on ``eta`` times as many, and
    so on; the last rung holds all rows.

    A rung fits every candidate left on the k folds of its share and compares the areas over all rows of the share.  Shares
    are nested and chosen by a hash of the id, so the work of a rung is about that of any other.  Returns
    ``(rung, share, candidate, learner, n_rows, auc)`` and ``(id, p)`` of the test rows: the mean of the winner's k models.
    """
    shared_dir(train.sparkSession)
    vectors = fit_vectors(train, config)
    rows = vectors.transform(train.withColumn("_share", share_of(F.col("id"))), label, ["_share"])
    dealt = fold_columns(train.select("id", F.col(label).alias("_class")), "id", "_class", k, (42,))
    rows = materialise(by_id(rows, dealt), "select")
    column = fold_column(42)
    report, left, models = [], list(candidates), {}
    for rung, (share, n) in enumerate(rungs(len(candidates), eta)):
        own = rows.where(F.col("_share") < share)
        size = own.count()
        tasks = fit_tasks(train, size)

        def fit(candidate: Candidate, fold: int, own: DataFrame = own, tasks: int = tasks):
            learner = make_learner(replace(config, learner=candidate.learner, params=dict(candidate.params)), vectors, 42)
            if candidate.learner == "logistic":
                scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
                learner = Pipeline(stages=[scaler, learner.copy({learner.featuresCol: "scaled"})])
            return candidate, fold, learner.fit(split_fold(own, fold, column)[0].coalesce(tasks))

        found = in_parallel(train, [lambda c=c, f=f, g=fit: g(c, f) for c in left for f in range(k)], at_once(train, threads, tasks))
        parts = [
            _score(m, own.where(F.col(column) == f), False).select("y", "p", F.lit(c.name).alias("candidate")) for c, f, m in found
        ]
        areas = {r["candidate"]: r["auc"] for r in auc(union(parts), by=["candidate"]).collect()}
        report += [(rung, share, c.name, c.learner, size, areas.get(c.name)) for c in left]
        ranked = sorted(left, key=lambda c: (-(areas.get(c.name) or 0.0), candidates.index(c)))
        left = ranked[: max(1, -(-n // eta))]
        models = {(0, f): m for c, f, m in found if c == left[0]}
    unlabelled = test if label in test.columns else test.withColumn(label, F.lit(None).cast("double"))
    out, means = vectors.transform(unlabelled, label), []
    for i, model in enumerate(models.values()):
        last = model.stages[-1] if hasattr(model, "stages") else model
        last.setPredictionCol(f"_prediction{i}").setProbabilityCol(f"_probability{i}").setRawPredictionCol(f"_raw{i}")
        out = model.transform(out)
        out = out.drop("scaled") if hasattr(model, "stages") else out
        means.append(vector_to_array(f"_probability{i}")[1])
    ahead = out.select("id", (reduce(add, means) / F.lit(float(len(means)))).alias("p"))
    schema = "rung int, share double, candidate string, learner string, n_rows long, auc double"
    return train.sparkSession.createDataFrame(report, schema), ahead


def compare_features(
    train: DataFrame, lists: Mapping[str, Sequence[str]], learner: str = "logistic", k: int = S.N_FOLDS,
    label: str = S.TARGET, params: Mapping[str, object] | None = None, threads: int = 4,
) -> DataFrame:
    """Out-of-fold area of one learner per named feature list: ``(features, n_pos, n_neg, auc)``."""
    parts = []
    for name, features in lists.items():
        config = ModelConfig(name, tuple(features), (), learner, (42,), params or {})
        parts.append(cross_fit(train, train.limit(0), config, k, label, threads).oof())
    return auc(union(parts), by=["model"]).withColumnRenamed("model", "features")


def adversarial_auc(
    train: DataFrame, test: DataFrame, features: Sequence[str], learner: str = "logistic", k: int = S.N_FOLDS,
    params: Mapping[str, object] | None = None, threads: int = 4,
) -> DataFrame:
    """How well a model tells train rows from test rows: out-of-fold AUC, 0.5 when it cannot."""
    both = union(
        [
            side.select("id", *features).withColumn("is_test", F.lit(flag))
            for side, flag in ((train, 0), (test, 1))
        ]
    )
    config = ModelConfig("adversarial", tuple(features), (), learner, (42,), params or {})
    return auc(cross_fit(both, both.limit(0), config, k, "is_test", threads).oof())


def members(
    sets: Mapping[str, Sequence[str]], categories: Sequence[str] = (), rounds: int | None = None,
    seeds: Sequence[int] = S.SEEDS, few_seeds: Sequence[int] = S.SEEDS[:3],
) -> list[ModelConfig]:
    """The ensemble: boosted trees on three feature sets, deeper boosted trees on two, a forest; segments apart."""
    boost = {} if rounds is None else {"maxIter": rounds}
    trees = {} if rounds is None else {"numTrees": max(2 * rounds, 4)}
    cats = tuple(categories)

    def member(name: str, features: str, learner: str, own_seeds: Sequence[int], params: Mapping[str, object]) -> ModelConfig:
        columns = sets[features]
        return ModelConfig(
            name, tuple(c for c in columns if c not in cats), tuple(c for c in columns if c in cats), learner, tuple(own_seeds), params
        )

    return [
        member("gbt_v3", "v3", "gbt", seeds, boost),
        member("gbt_v3_te", "v3_te", "gbt", seeds, boost),
        member("deep_v3", "v3", "gbt_deep", few_seeds, boost),
        member("deep_full", "full_cat", "gbt_deep", few_seeds, boost),
        member("forest_full", "full_cat", "forest", few_seeds, trees),
    ]
