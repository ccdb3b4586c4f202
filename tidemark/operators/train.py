"""Training with MLlib: preprocessing stages, model registry, folds, search.

Everything fitted is a persistable ``PipelineModel`` plus the feature
statistics, so a saved model scores tables and streams alike.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from hashlib import md5

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.shape import sql_name, sql_text
from tidemark.functions.stage import spread, staged
from tidemark.operators import features as fe
from tidemark.operators import prep
from tidemark.operators.batch_fit import LogisticBatch, Penalty
from tidemark.operators.boost import BoostedTreesClassifier, Boosting, Setting
from tidemark.operators.balance import smote_tomek, with_weights
from tidemark.operators.clean import binary_target, drop_null_target, fix_total
from tidemark.operators.evaluate import average_precision, best_threshold, evaluate, roc_auc, score_ledger
from tidemark.roles import Roles

# name -> (class, accepted parameter -> MLlib parameter, values that always win)
REGISTRY = {
    "gbt": (
        GBTClassifier,
        {
            "n_estimators": "maxIter",
            "learning_rate": "stepSize",
            "subsample": "subsamplingRate",
            "colsample_bytree": "featureSubsetStrategy",
            "max_depth": "maxDepth",
            "min_child_samples": "minInstancesPerNode",
            "gamma": "minInfoGain",
            "random_state": "seed",
        },
        {},
    ),
    "random_forest": (
        RandomForestClassifier,
        {
            "n_estimators": "numTrees",
            "subsample": "subsamplingRate",
            "colsample_bytree": "featureSubsetStrategy",
            "max_depth": "maxDepth",
            "min_child_samples": "minInstancesPerNode",
            "gamma": "minInfoGain",
            "random_state": "seed",
        },
        {},
    ),
    "boosted": (BoostedTreesClassifier, {name: name for name in Setting.__dataclass_fields__}, {}),
    "logistic_regression": (LogisticRegression, {"max_iter": "maxIter", "reg_lambda": "regParam", "reg_alpha": "elasticNetParam", "tol": "tol"}, {}),
}

#: Spark jobs of a search or cross-validation that are submitted side by side.
PARALLEL = 4
#: Algorithms whose folds and trials are fitted in shared passes.
BATCHED = ("boosted", "logistic_regression")
#: A search of boosted trees keeps the best third of its trials after so many trees.
RUNGS, KEPT = (25, 75), 3


@dataclass(frozen=True)
class Range:
    """Bounds of a tunable parameter and how it spreads between them: 'whole', 'even' or 'log'."""

    low: float
    high: float
    kind: str = "even"

    def at(self, u: float) -> float | int:
        """The value a share ``u`` in [0, 1) of the way."""
        if self.kind == "whole":
            return int(self.low + math.floor(u * (self.high - self.low + 1)))
        if self.kind == "log":
            return self.low * (self.high / self.low) ** u
        return self.low + u * (self.high - self.low)


# fixed values: the tunable parameters and their bounds
SEARCH_SPACE = {
    "n_estimators": Range(100, 500, "whole"),
    "max_depth": Range(3, 10, "whole"),
    "learning_rate": Range(0.01, 0.3, "log"),
    "subsample": Range(0.6, 1.0),
    "colsample_bytree": Range(0.6, 1.0),
    "min_child_samples": Range(5, 100, "whole"),
    "gamma": Range(0.0, 0.01),
    "reg_lambda": Range(0.0, 1.0),
    "reg_alpha": Range(0.0, 1.0),
}


def create_model(algorithm: str, params: Mapping[str, object]):
    """Classifier by name; parameters it does not know are left out."""
    if algorithm not in REGISTRY:
        raise ValueError(f"unknown algorithm {algorithm!r}; known: {', '.join(sorted(REGISTRY))}")
    cls, names, fixed = REGISTRY[algorithm]
    given = {names[k]: v for k, v in params.items() if k in names and v is not None}
    if "featureSubsetStrategy" in given:
        given["featureSubsetStrategy"] = str(float(given["featureSubsetStrategy"]))
    return cls(featuresCol="features", labelCol="label", **{**given, **fixed})


def auto_roles(df: DataFrame, skip: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return numeric, text


def _double(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"CAST('{float(x)!r}' AS DOUBLE)"


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    scaler: str | None = "robust",
    numeric_fill: str = "median",
    categorical_fill: str = "most_frequent",
    handle_unknown: str = "ignore",
    drop_first: bool = False,
    passthrough: Sequence[str] = (),
) -> PipelineModel:
    """Filled and scaled numbers, one-hot categories, assembled as ``features``.

    Columns in ``passthrough`` (numbers) are added as they are; others are left out.
    """
    if not numeric and not categorical:
        raise ValueError("no columns to prepare")
    if isinstance(numeric, str) or isinstance(categorical, str):
        raise TypeError("column lists must be lists or tuples")
    if scaler not in prep.SCALERS:
        raise ValueError(f"scaler must be one of {prep.SCALERS}")
    if handle_unknown not in ("ignore", "error"):
        raise ValueError("handle_unknown must be 'ignore' or 'error'")
    parts, inputs = [], []
    if numeric:
        fills = prep.numeric_fills(train, numeric, numeric_fill)
        scaled = prep.scales(train, numeric, scaler, fills)
        for c in numeric:
            x = f"coalesce(nanvl(try_cast({sql_name(c)} AS DOUBLE), NULL), {_double(fills.get(c))})"
            s = scaled.get(c)
            out = f"({x} - {_double(s.centre)}) / {_double(s.spread)}" if s else x
            parts.append(f"{out} AS {sql_name('num__' + c)}")
            inputs.append(f"num__{c}")
    if categorical:
        fills = prep.categorical_fills(train, categorical, categorical_fill)
        for c in categorical:
            parts.append(f"coalesce(CAST({sql_name(c)} AS STRING), {sql_text(fills.get(c) or 'missing')}) AS {sql_name('_text_' + c)}")
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")]
    if categorical:
        text, code, hot = ([f"{p}{c}" for c in categorical] for p in ("_text_", "_code_", "cat__"))
        ignore = handle_unknown == "ignore"
        # with 'keep' the unknown values take one last slot, which dropLast removes again
        stages.append(
            StringIndexer(
                inputCols=text, outputCols=code, stringOrderType="alphabetAsc", handleInvalid="keep" if ignore else "error"
            )
        )
        stages.append(OneHotEncoder(inputCols=code, outputCols=hot, dropLast=ignore))
        inputs += hot
    fitted = Pipeline(stages=stages).fit(train)
    tail = []
    if categorical and drop_first:
        labels = fitted.stages[1].labelsArray
        for i, c in enumerate(categorical):
            if len(labels[i]) > 1:
                tail.append(VectorSlicer(inputCol=f"cat__{c}", outputCol=f"cut__{c}", indices=list(range(1, len(labels[i])))))
                inputs[inputs.index(f"cat__{c}")] = f"cut__{c}"
            else:
                inputs.remove(f"cat__{c}")
    inputs += list(passthrough)
    tail.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return PipelineModel(stages=[*fitted.stages, *tail])


def feature_names(prepared: DataFrame) -> list[str]:
    """Names of the slots of ``features`` from its column metadata."""
    groups = prepared.schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [name for _, name in slots]


@dataclass(frozen=True)
class ModelSpec:
    algorithm: str = "gbt"
    params: Mapping[str, object] = field(default_factory=dict)
    engineered: bool = True
    resample: bool = False
    neighbours: str = "exact"
    weighted: bool = False
    scaler: str | None = "robust"
    seed: int = 42


@dataclass
class ChurnModel:
    """A fitted model with what it needs to score raw rows."""

    pipeline: PipelineModel
    stats: fe.FeatureStats | None
    roles: Roles
    spec: ModelSpec
    threshold: float = 0.5
    cv_metrics: dict[str, float] = field(default_factory=dict)
    test_metrics: dict[str, float] = field(default_factory=dict)

    def prepared(self, df: DataFrame) -> DataFrame:
        """Rows with derived columns and the ``features`` vector."""
        rows = fe.transform(df, self.roles, self.stats) if self.stats else fix_total(df, self.roles)
        return PipelineModel(stages=self.pipeline.stages[:-1]).transform(rows)

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """(key, keep, p, prediction); works on streams too."""
        scored = self.pipeline.stages[-1].transform(self.prepared(df))
        p = vector_to_array("probability")[1]
        names = [self.roles.key, *keep]
        return scored.select(*names, p.alias("p")).withColumn(
            "prediction", (F.col("p") >= F.lit(float(self.threshold))).cast("int")
        )

    def scores(self, df: DataFrame, *keep: str) -> DataFrame:
        """(key, keep, model, y, p): the form the evaluation operators read."""
        labelled = binary_target(drop_null_target(df, self.roles.target), self.roles.target, self.roles.positive)
        out = self.score(labelled, [self.roles.target, *keep])
        return out.select(
            self.roles.key, *keep, F.lit(self.spec.algorithm).alias("model"), F.col(self.roles.target).alias("y"), "p"
        )

    def save(self, folder: str) -> None:
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{folder}/pipeline")
        if self.stats:
            self.stats.save(spark, f"{folder}/features")
        meta = {
            "roles": asdict(self.roles),
            "spec": {**asdict(self.spec), "params": dict(self.spec.params)},
            "threshold": self.threshold,
            "cv_metrics": self.cv_metrics,
            "test_metrics": self.test_metrics,
            "engineered": self.stats is not None,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/meta")

    @classmethod
    def load(cls, folder: str) -> ChurnModel:
        spark = SparkSession.active()
        meta = json.loads(spark.read.text(f"{folder}/meta").first().value)
        tuples = lambda v: tuple(v) if isinstance(v, list) else v
        roles = {k: tuples(v) for k, v in meta["roles"].items()}
        for k in ("numeric_ranges", "valid_values"):
            roles[k] = {c: tuple(v) for c, v in roles[k].items()}
        stats = fe.FeatureStats.load(spark, f"{folder}/features") if meta["engineered"] else None
        return cls(
            PipelineModel.load(f"{folder}/pipeline"),
            stats,
            Roles(**roles),
            ModelSpec(**meta["spec"]),
            meta["threshold"],
            meta["cv_metrics"],
            meta["test_metrics"],
        )


@dataclass(frozen=True)
class Prepared:
    """What does not depend on a model's parameters: fitted stages, statistics and the table to learn from."""

    stages: PipelineModel
    stats: fe.FeatureStats | None
    ready: DataFrame
    weighted: bool

    def fit(self, spec: ModelSpec):
        estimator = create_model(spec.algorithm, {"random_state": spec.seed, **spec.params})
        ready = self.ready if spec.algorithm in BATCHED else spread(self.ready, self.ready.count())
        return (estimator.setWeightCol("weight") if self.weighted else estimator).fit(ready)


def prepare(
    train: DataFrame,
    roles: Roles,
    spec: ModelSpec,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    skip: Sequence[str] = (),
) -> Prepared:
    """Features and preprocessing learned on the training rows; synthetic rows, if asked for, are made after it.

    Rows without a label are left out.
    """
    train = binary_target(drop_null_target(train, roles.target), roles.target, roles.positive)
    stats = fe.fit(train, roles) if spec.engineered else None
    rows = staged(fe.transform(train, roles, stats) if stats else fix_total(train, roles), "train")
    auto_num, auto_cat = auto_roles(rows, [roles.key, roles.target, *skip])
    numeric = auto_num if numeric is None else list(numeric)
    categorical = auto_cat if categorical is None else list(categorical)
    stages = fit_preprocessor(rows, numeric, categorical, spec.scaler)
    ready = stages.transform(rows).select(roles.key, "features", F.col(roles.target).cast("double").alias("label"))
    weighted = spec.weighted and not spec.resample
    if spec.resample:
        meta = ready.schema["features"].metadata
        arrays = ready.select(roles.key, vector_to_array("features").alias("vec"), F.col("label").cast("int").alias("y"))
        mixed = smote_tomek(staged(arrays, "vectors"), roles.key, "vec", "y", seed=spec.seed, search=spec.neighbours)
        ready = mixed.select(
            array_to_vector("vec").alias("features", metadata=_continuous(meta)), F.col("y").cast("double").alias("label")
        )
    elif weighted:
        ready = with_weights(ready, "label")
    return Prepared(stages, stats, staged(ready, "ready"), weighted)


def fit_model(train: DataFrame, roles: Roles, spec: ModelSpec, **columns) -> ChurnModel:
    """Features, preprocessing and classifier, all learned on the training rows.

    ``columns`` are those of ``prepare``.
    """
    done = prepare(train, roles, spec, **columns)
    return ChurnModel(PipelineModel(stages=[*done.stages.stages, done.fit(spec)]), done.stats, roles, spec)


def _continuous(meta: dict) -> dict:
    """Slot metadata with every slot numeric: mixed rows hold values between categories."""
    attrs = meta["ml_attr"]["attrs"]
    slots = sorted(({"idx": a["idx"], "name": a["name"]} for v in attrs.values() for a in v), key=lambda a: a["idx"])
    return {"ml_attr": {**meta["ml_attr"], "attrs": {"numeric": slots}}}


# ---------------------------------------------------------------- folds


@dataclass(frozen=True)
class Fold:
    """One fold, prepared on the rows outside it, and the rows inside with their ``features``."""

    prepared: Prepared
    held: DataFrame


def prepare_folds(df: DataFrame, roles: Roles, spec: ModelSpec, k: int = 5, **columns) -> list[Fold]:
    """Seeded folds, each prepared once; any number of models can then be fitted on them."""
    labelled = binary_target(drop_null_target(df, roles.target), roles.target, roles.positive)
    folded = staged(prep.assign_folds(labelled, roles.key, roles.target, k, spec.seed), "folds")

    def one(i: int) -> Fold:
        done = prepare(folded.where(F.col("fold") != i).drop("fold"), roles, spec, **columns)
        rows = folded.where(F.col("fold") == i)
        ready = done.stages.transform(fe.transform(rows, roles, done.stats) if done.stats else fix_total(rows, roles))
        return Fold(done, staged(ready.select(roles.key, "fold", F.col(roles.target).alias("y"), "features"), "held"))

    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(one, range(k)))


def score_fold(fold: Fold, roles: Roles, spec: ModelSpec) -> DataFrame:
    """(key, fold, model, y, p) of the fold's rows by a model fitted outside it."""
    p = vector_to_array("probability")[1].alias("p")
    return fold.prepared.fit(spec).transform(fold.held).select(roles.key, "fold", F.lit(spec.algorithm).alias("model"), "y", p)


def out_of_fold(df: DataFrame, roles: Roles, spec: ModelSpec, k: int = 5, **columns) -> DataFrame:
    """(key, fold, model, y, p): each row scored by the model that did not see it."""
    return score_folds(prepare_folds(df, roles, spec, k, **columns), roles, spec)


def fold_rows(folds: Sequence[Fold], roles: Roles) -> DataFrame:
    """(fold, name, y, weight, held, x): the rows each fold learns from, and those it holds back."""
    parts = []
    for i, fold in enumerate(folds):
        ready, held = fold.prepared.ready, fold.held
        # rows made by resampling have no key; the table is written, so their numbers stay
        name = F.col(roles.key) if roles.key in ready.columns else F.monotonically_increasing_id()
        weight = F.col("weight").cast("double") if fold.prepared.weighted else F.lit(1.0)
        x = vector_to_array("features").alias("x")
        same = lambda name, y, weight, held: [F.lit(i).alias("fold"), name.cast("string").alias("name"), F.col(y).cast("double").alias("y"), weight.alias("weight"), F.lit(held).alias("held"), x]  # noqa: E731, B023
        parts += [ready.select(*same(name, "label", weight, False)), held.select(*same(F.col(roles.key), "y", F.lit(1.0), True))]
    return staged(reduce(DataFrame.unionByName, parts), "fold-rows")


def score_folds(folds: Sequence[Fold], roles: Roles, spec: ModelSpec) -> DataFrame:
    """(key, fold, model, y, p) of every row by the model of the other folds; all folds at once where passes can be shared."""
    if spec.algorithm in BATCHED:
        rows = fold_rows(folds, roles)
        if spec.algorithm == "boosted":
            setting = Setting.of({"random_state": spec.seed, **spec.params})
            boosting = Boosting(rows, [setting])
            boosting.run(setting.n_estimators, [0])
            scored = boosting.held_scores([0])
        else:
            scored = LogisticBatch(rows, [_penalty(spec.params)], int(spec.params.get("max_iter", 100))).fit().held_scores()
        key = F.col("name").cast(folds[0].held.schema[roles.key].dataType).alias(roles.key)
        y = F.col("y").cast(folds[0].held.schema["y"].dataType).alias("y")
        return staged(scored.select(key, "fold", F.lit(spec.algorithm).alias("model"), y, "p"), "oof")
    with ThreadPoolExecutor(PARALLEL) as pool:
        parts = list(pool.map(lambda f: score_fold(f, roles, spec), folds))
    return staged(reduce(DataFrame.unionByName, parts), "oof")


def _penalty(params: Mapping[str, object]) -> Penalty:
    return Penalty(float(params.get("reg_lambda", 0.0)), float(params.get("reg_alpha", 0.0)))


def fold_metrics(oof: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per fold with all metrics."""
    return evaluate(oof, threshold, ["fold"])


def cross_validate(oof: DataFrame) -> dict[str, float]:
    """Mean and population deviation of F1 and AUC over the folds."""
    row = fold_metrics(oof).agg(
        F.avg("f1_score").alias("cv_f1_mean"),
        F.stddev_pop("f1_score").alias("cv_f1_std"),
        F.avg("roc_auc").alias("cv_roc_auc_mean"),
        F.stddev_pop("roc_auc").alias("cv_roc_auc_std"),
    ).first()
    return row.asDict()


# ---------------------------------------------------------------- search


def draw(seed: int, trial: int, name: str) -> float:
    """A number in [0, 1) from the first 13 hex digits of an md5, the same in any engine."""
    return int(md5(f"{seed}-{trial}-{name}".encode()).hexdigest()[:13], 16) / 16.0**13


def draw_params(algorithm: str, space: Mapping[str, Range], seed: int, trial: int) -> dict[str, object]:
    """The setting of a trial for the parameters the algorithm knows, each drawn by its range's kind."""
    known = REGISTRY[algorithm][1]
    return {name: space[name].at(draw(seed, trial, name)) for name in sorted(space) if name in known}


@dataclass
class SearchResult:
    trials: DataFrame
    best_spec: ModelSpec
    best_value: float
    best_threshold: float


def objectives(oof: DataFrame, by: Sequence[str], metric: str, optimise_threshold: bool) -> DataFrame:
    """(by, value, threshold): the best F1 with its threshold, or the mean over the folds of a metric."""
    if optimise_threshold:
        top = best_threshold(score_ledger(oof, by), by=by)
        return top.select(*by, F.col("score").alias("value"), "threshold")
    each = [*by, "fold"]
    if metric == "auprc":
        found = average_precision(score_ledger(oof, each), each)
    elif metric == "roc_auc":
        found = roc_auc(score_ledger(oof, each), each)
    else:
        found = evaluate(oof, 0.5, each).withColumnRenamed("f1_score", metric)
    return found.groupBy(*by).agg(F.avg(metric).alias("value")).withColumn("threshold", F.lit(0.5))


@dataclass(frozen=True)
class Trial:
    number: int
    spec: ModelSpec
    params: Mapping[str, object]
    value: float
    threshold: float
    state: str = "COMPLETE"


def _boosted_trials(folds: Sequence[Fold], roles: Roles, drawn: Sequence[tuple[int, ModelSpec, dict]], judge, rungs: Sequence[int]) -> list[Trial]:
    """All trials and folds together; after each rung the best third of the unfinished trials goes on."""
    settings = [Setting.of({"random_state": spec.seed, **spec.params}) for _, spec, _ in drawn]
    boosting = Boosting(fold_rows(folds, roles), settings)
    alive, done = list(range(len(drawn))), {}

    def judged(state: str, chosen: Sequence[int], found: Mapping[int, tuple[float, float]]) -> None:
        for i in chosen:
            number, spec, params = drawn[i]
            done[i] = Trial(number, spec, params, *found[i], state)

    for rung in rungs:
        boosting.run(rung, alive)
        open_ = [i for i in alive if settings[i].n_estimators > rung]
        if len(open_) < 2:
            continue
        found = judge(boosting.held_scores(alive))
        ranked = sorted(open_, key=lambda i: (-found[i][0], drawn[i][0]))
        gone = set(ranked[-(-len(ranked) // KEPT) :])
        judged("PRUNED", sorted(gone), found)
        alive = [i for i in alive if i not in gone]
    boosting.run(max(settings[i].n_estimators for i in alive), alive)
    judged("COMPLETE", alive, judge(boosting.held_scores(alive)))
    return list(done.values())


def _logistic_trials(folds: Sequence[Fold], roles: Roles, drawn: Sequence[tuple[int, ModelSpec, dict]], judge) -> list[Trial]:
    """All trials and folds in the same passes; as many passes as the most that a trial asks for."""
    passes = max(int(spec.params.get("max_iter", 100)) for _, spec, _ in drawn)
    found = judge(LogisticBatch(fold_rows(folds, roles), [_penalty(spec.params) for _, spec, _ in drawn], passes).fit().held_scores())
    return [Trial(number, spec, params, *found[i]) for i, (number, spec, params) in enumerate(drawn)]


def search(
    train: DataFrame,
    roles: Roles,
    spec: ModelSpec,
    space: Mapping[str, Range] = SEARCH_SPACE,
    n_trials: int = 50,
    k: int = 5,
    metric: str = "f1",
    optimise_threshold: bool = True,
    patience: int | None = None,
    algorithms: Sequence[str] | None = None,
    rungs: Sequence[int] = RUNGS,
    **columns,
) -> SearchResult:
    """Seeded random search.

    The objective is the best F1 over the out-of-fold scores, with the
    threshold that gives it, or the mean over the folds of 'f1', 'roc_auc' or
    'auprc'. Folds are prepared once. Trials of boosted trees and of logistic
    regression are fitted together, all folds of all trials in each pass;
    boosted trials that are not among the best third after a rung end there
    ('PRUNED', with the value they had). Other algorithms go trial by trial,
    ``PARALLEL`` side by side, until ``patience`` trials brought no gain; trials
    already under way then are listed as 'SURPLUS' and not chosen.
    """
    folds = prepare_folds(train, roles, spec, k, **columns)
    names = list(algorithms or [spec.algorithm])
    drawn: dict[str, list[tuple[int, ModelSpec, dict]]] = {}
    for number in range(n_trials):
        algorithm = names[int(draw(spec.seed, number, "algorithm") * len(names))]
        params = draw_params(algorithm, space, spec.seed, number)
        drawn.setdefault(algorithm, []).append((number, replace(spec, algorithm=algorithm, params={**spec.params, **params}), params))

    def judge(scored: DataFrame) -> dict[int, tuple[float, float]]:
        found = objectives(staged(scored, "oof"), ["setting"], metric, optimise_threshold)
        return {r.setting: (float(r.value), float(r.threshold)) for r in found.collect()}  # one row per trial

    def one(item: tuple[int, ModelSpec, dict]) -> Trial:
        number, trial, params = item
        oof = staged(reduce(DataFrame.unionByName, [score_fold(f, roles, trial) for f in folds]), "oof")
        top = objectives(oof, ["model"], metric, optimise_threshold).first()
        return Trial(number, trial, params, float(top.value), float(top.threshold))

    trials: list[Trial] = []
    if "boosted" in drawn:
        trials += _boosted_trials(folds, roles, drawn.pop("boosted"), judge, rungs)
    if "logistic_regression" in drawn:
        trials += _logistic_trials(folds, roles, drawn.pop("logistic_regression"), judge)
    best, idle = max((t.value for t in trials), default=-math.inf), 0
    queue = sorted((item for items in drawn.values() for item in items), key=lambda item: item[0])
    with ThreadPoolExecutor(PARALLEL) as pool:
        while queue and not (patience and idle >= patience):
            now, queue = queue[:PARALLEL], queue[PARALLEL:]
            for trial in pool.map(one, now):
                if patience and idle >= patience:
                    trial = replace(trial, state="SURPLUS")
                elif trial.value > best:
                    best, idle = trial.value, 0
                else:
                    idle += 1
                trials.append(trial)
    trials.sort(key=lambda t: t.number)
    top = max((t for t in trials if t.state == "COMPLETE"), key=lambda t: (t.value, -t.number))
    rows = [(t.number, t.value, t.spec.algorithm, {p: float(v) for p, v in t.params.items()}, t.state, t.threshold) for t in trials]
    schema = "number int, value double, algorithm string, params map<string,double>, state string, threshold double"
    return SearchResult(train.sparkSession.createDataFrame(rows, schema), top.spec, top.value, top.threshold)


def best_per_algorithm(trials: DataFrame) -> DataFrame:
    """Best trial of each algorithm, the earliest on a tie."""
    return trials.where("value is not null AND state = 'COMPLETE'").groupBy("algorithm").agg(
        F.min_by("number", F.struct(-F.col("value"), F.col("number"))).alias("number"), F.max("value").alias("value")
    )


def refit(train: DataFrame, roles: Roles, found: SearchResult, **columns) -> ChurnModel:
    """The best setting on all training rows, with its threshold."""
    model = fit_model(train, roles, found.best_spec, **columns)
    model.threshold = found.best_threshold
    return model


# ---------------------------------------------------------------- importance


def importances(model: ChurnModel, df: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, importance, rank) of the fitted classifier: its importances, or
    the size of its coefficients."""
    fitted = model.pipeline.stages[-1]
    vector = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    names = feature_names(model.prepared(df))
    pairs = sorted(((abs(float(v)), n) for v, n in zip(vector.toArray(), names)), key=lambda t: (-t[0], t[1]))
    rows = [(n, v, i + 1) for i, (v, n) in enumerate(pairs[:top])]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, rank int")
