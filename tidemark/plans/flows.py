"""The three monthly flows: train, score, evaluate.

What the tables are is up to the caller: audiences, features, targets and scoring sets come from
functions ``(spark, month) -> DataFrame``. Months are ``yyyyMM`` labels or, with ``unit='week'``,
``yyyy-MM-dd`` ones. Run stamps are arguments; nothing here reads the clock.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.periods import period_start, shift_label
from tidemark.operators.datasets import (
    evaluation_set,
    join_scores_labels,
    profile,
    sample_n,
    scoring_set,
    train_test,
    training_set,
    undersample,
)
from tidemark.operators.evaluation import eval_table_class, eval_table_regr, lift_table
from tidemark.operators.metrics import (
    classification_report,
    confusion_bins,
    regression_metrics,
    roc_auc,
    spearman,
)
from tidemark.operators.prep import fit_prep
from tidemark.operators.registry import champion_decision, metric_percent, select_model
from tidemark.operators.scoring import batch_score, latest_scores, score_table_class, score_table_regr
from tidemark.operators.stages import fit_score_calibration
from tidemark.operators.training import Metric, fit_model, mean_squared_error, search
from tidemark.session import stored
from tidemark.sources.datasets import append_run, materialize
from tidemark.sources.models import load_model, save_model

TableFor = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Project:
    """What a model is about and how it is built."""

    model_name: str
    kind: str  # classification or regression
    key: str
    audience: TableFor
    features: TableFor
    target: TableFor
    categories: Sequence[str]
    numbers: Sequence[str]
    scoring_base: TableFor | None = None
    unit: str = "month"
    target_advance: int = 1
    n_samples: int | None = None
    balance: bool = False
    drop: Sequence[str] = ()
    test_share: float = 0.5
    variance_threshold: float | None = None
    model_params: Mapping[str, Any] = field(default_factory=dict)
    scale: bool = False
    extra: Sequence[Any] = ()  # further Spark ML stages over the features
    make: Callable[..., Any] | None = None  # another estimator
    unbalanced: bool = False  # weigh the classes
    space: Mapping[str, tuple] | None = None  # parameters to search
    trials: int = 50
    tune_metric: Metric = mean_squared_error
    tune_direction: str = "minimize"
    rungs: Sequence[float] = (1.0,)  # shares of the rows that trials are fitted on, the best going on
    parallel_trials: int = 1
    calibration: str = "none"  # or sigmoid, isotonic: of the stored model's probabilities
    threshold: bool = False  # predict class 1 from the best threshold on
    calibration_share: float = 0.2  # of the fitting part, held out for calibration and threshold
    edges: Sequence[float] = tuple(range(11))
    bin_on: str = "value"  # or rank: what the edges of a regression apply to
    seed: int = 42

    def later(self, month: str, periods: int) -> str:
        return shift_label(month, periods, self.unit)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    report: DataFrame
    metric: DataFrame
    metadata: DataFrame
    path: str
    trials: DataFrame | None = None


def build_training_set(spark: SparkSession, p: Project, month: str) -> DataFrame:
    """Audience and features of the month, target of the month plus the advance."""
    rows = training_set(
        p.audience(spark, month),
        p.features(spark, month),
        p.target(spark, p.later(month, p.target_advance)),
        p.key,
        drop=p.drop,
    )
    return sample_n(rows, p.key, p.n_samples, p.seed)


def build_scoring_set(spark: SparkSession, p: Project, month: str) -> DataFrame:
    """Next month's rows: a ready scoring base, or audience with features."""
    ahead = p.later(month, 1)
    if p.scoring_base is not None:
        return p.scoring_base(spark, ahead)
    return scoring_set(p.audience(spark, ahead), p.features(spark, ahead), p.key, p.drop)


def build_evaluation_set(spark: SparkSession, p: Project, month: str) -> DataFrame:
    """Next month's audience with the target that came true after the advance."""
    ahead = p.later(month, 1)
    return evaluation_set(p.audience(spark, ahead), p.target(spark, p.later(month, p.target_advance + 1)), p.key)


def _stage(spark: SparkSession, p: Project, flow: str, month: str, base: str, policy: str, build) -> DataFrame:
    """A stage dataset. Splits and ranks read it several times, so even with ``never`` there is a
    scratch copy in the shared folder; no later run reads that one."""
    if policy == "never":
        return stored(build(spark, p, month), flow)
    return materialize(lambda: build(spark, p, month), spark, f"{base}/{p.model_name}/{flow}", month, policy)


def train(
    spark: SparkSession, p: Project, month: str, run: str, base: str, models: str, policy: str = "always"
) -> Trained:
    """Build the set once, fit preparation and model on one part, report on the other, save.

    With ``space`` the parameters are searched first, on the fitting part alone. With ``calibration`` or
    ``threshold`` the stored model ends in a stage that gives calibrated probabilities and predicts class 1
    from the best threshold on; both are found on a share held out of the fit.
    """
    rows = _stage(spark, p, "train", month, base, policy, build_training_set)
    if p.balance:
        rows = undersample(rows, "target", p.key, p.seed)
    fit_rows, test_rows = train_test(rows, p.key, p.test_share, p.seed)
    own_rows = None
    if p.kind == "classification" and (p.threshold or p.calibration != "none"):
        # Calibration and threshold see rows of their own: scores of fitted rows are too sure.
        fit_rows, own_rows = train_test(fit_rows, p.key, p.calibration_share, p.seed + 1)
    prep = fit_prep(fit_rows, p.categories, p.numbers, "target", p.variance_threshold, scale=p.scale, extra=p.extra)
    prepared, params, trials = prep.transform(fit_rows), dict(p.model_params), None
    if p.space:
        prepared = stored(prepared.select(p.key, "target", "features"), "prepared")
    if p.space:
        found = search(
            prepared, p.key, p.kind, p.space, p.tune_metric, p.tune_direction, p.trials, p.seed, params=params, make=p.make, rungs=p.rungs, parallel=p.parallel_trials
        )
        params, trials = params | found.best_params, found.trials
    fitted: Model = fit_model(prepared, p.kind, params, unbalanced=p.unbalanced, make=p.make)
    last = []
    if own_rows is not None:
        seen = fitted.transform(prep.transform(own_rows).select("target", "features"))
        last = [fit_score_calibration(seen, "target", p.calibration, p.threshold)]
    model = PipelineModel(stages=[*prep.stages, fitted, *last])
    path = save_model(model, models, p.model_name, month, run)
    scored = model.transform(test_rows)
    if p.kind == "classification":
        scored = scored.withColumn("p1", vector_to_array("probability")[1])
        report = classification_report(scored, "target", "prediction")
        metric = roc_auc(scored, "p1", "target")
    else:
        report = regression_metrics(scored, "target", "prediction")
        metric = spearman(scored, "target", "prediction", p.key)
    facts = [profile(rows, "target", "dataset"), profile(fit_rows, "target", "train")]
    return Trained(model, report, metric, reduce(DataFrame.unionByName, facts), path, trials)


def challenge(
    p: Project, champions: DataFrame, metric: DataFrame, month: str, run: str, tolerance: float = 0, target: str | None = None
) -> DataFrame:
    """The champion decision for a run whose metric is a one-row table (metric in percent); an accepted
    champion is appended to ``target`` if that is given."""
    candidate = metric.select(
        F.lit(p.model_name).alias("MODEL_NAME"),
        F.lit(run).alias("DT_TRAIN"),
        metric_percent(F.col(metric.columns[0])).alias("METRIC"),
        F.lit(period_start(month, p.unit)).alias("SAFRA"),
    )
    decision = champion_decision(champions, candidate, tolerance)
    if target is not None:
        append_run(decision.where("accepted"), target, candidate.columns, f"{p.model_name}-{month}-{run}")
    return decision


def score(
    spark: SparkSession,
    p: Project,
    model: PipelineModel,
    month: str,
    run: str,
    train_run: str,
    base: str,
    policy: str = "always",
) -> DataFrame:
    """Score next month's rows into the stored score table.

    Ranking reads the scores several times, so they are written once before.
    """
    ahead = p.later(month, 1)
    stamp = period_start(ahead, p.unit)

    def raw(s: SparkSession, project: Project, m: str) -> DataFrame:
        return batch_score(model, build_scoring_set(s, project, m), project.key, project.kind)

    scored = _stage(spark, p, f"score-{run}", month, base, policy, raw)
    if p.kind == "classification":
        return score_table_class(scored, p.key, "p0", "p1", p.model_name, stamp, run, train_run)
    return score_table_regr(scored, p.key, "pred", p.edges, p.model_name, stamp, run, train_run, p.bin_on)


def score_selected(
    spark: SparkSession,
    p: Project,
    registry: DataFrame,
    champions: DataFrame | None,
    models: str,
    month: str,
    run: str,
    base: str,
    target: str | None = None,
    policy: str = "always",
) -> DataFrame:
    """:func:`score` with the champion, or else the last run trained up to the month, loaded from
    ``models``; the table is appended to ``target`` if that is given, once however often the run is tried."""
    pick = select_model(registry, champions, p.model_name, period_start(month, p.unit)).first()
    if pick is None:
        raise LookupError(f"no trained model of {p.model_name} up to {month}")
    trained = pick["SAFRA"].strftime("%Y%m" if p.unit == "month" else "%Y-%m-%d")
    model = load_model(models, p.model_name, trained, pick["DT_TRAIN"])
    table = score(spark, p, model, month, run, pick["DT_TRAIN"], base, policy)
    if target is not None:
        append_run(table, target, table.columns, f"{p.model_name}-{month}-{run}")
    return table


def evaluate(
    spark: SparkSession, p: Project, scores: DataFrame, month: str, run: str, base: str, policy: str = "always", target: str | None = None
) -> DataFrame:
    """Join the last scores of next month with the targets and build the evaluation table, which is
    appended to ``target`` if that is given."""
    stamp = period_start(p.later(month, 1), p.unit)
    labels = _stage(spark, p, "eval", month, base, policy, build_evaluation_set)
    last = latest_scores(scores, p.model_name, stamp)
    train_run = last.select(F.max("DT_TRAIN").alias("t")).scalar()
    rows = join_scores_labels(labels, last, p.key)
    if p.kind == "classification":
        # Deciles of the stored, truncated scores.
        lift = lift_table(rows, "SCORES_0", "target", 10, p.key)
        table = eval_table_class(lift, p.model_name, stamp, run, train_run)
    else:
        rows = rows.withColumn("SCORES", F.col("SCORES").cast("double"))
        bins = confusion_bins(rows, "target", "SCORES", p.edges, p.bin_on, p.key)
        table = eval_table_regr(bins, p.model_name, stamp, run, train_run)
    if target is not None:
        append_run(table, target, table.columns, f"{p.model_name}-{month}-{run}")
    return table
