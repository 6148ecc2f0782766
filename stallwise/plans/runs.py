"""The monitoring run and the retraining run, each from stored tables to stored results."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.operators import drift, splits
from stallwise.plans import modeling, monitoring, retraining
from stallwise.session import fresh_path
from stallwise.sources import sinks

ALGORITHM = "logistic_regression"
# Before any model was trained.
NEVER = "2000-01-01"
FIRST_VERSION = "v1"


def monitor(
    bridge: DataFrame,
    features: DataFrame,
    registry: DataFrame,
    snapshot: Callable[[str], DataFrame],
    reports_path: str,
    run_at: Column,
    configured_auc: float | None = None,
) -> DataFrame:
    """Appends one report and returns it: quality of the scored orders, drift of all current features.

    Baseline AUC and training snapshot come from the registry (one row, or none) unless configured;
    ``snapshot`` reads a training snapshot by name.
    """
    baseline = monitoring.baseline_lookup(registry, configured_auc).first()
    if baseline["baseline_roc_auc"] is None:
        raise ValueError("no baseline AUC: neither configured nor in the registry")
    train = snapshot(baseline["train_snapshot"])
    report = monitoring.monitoring_report(
        monitoring.scored_frame(bridge), drift.drift_report(train, features), run_at, baseline["baseline_roc_auc"]
    )
    sinks.append_report(report, reports_path)
    return sinks.latest_report(bridge.sparkSession.read.parquet(reports_path))


def last_retrained(registry: DataFrame, state: str | None) -> DataFrame:
    """(last_retrain): the recorded date, else the active model's training date, else a date before all models."""
    return registry.agg(
        F.coalesce(F.lit(state).cast("date"), F.max("trained_on"), F.lit(NEVER).cast("date")).alias("last_retrain")
    )


def decide(report: DataFrame, registry: DataFrame, today: Column, state: str | None = None, force: bool = False) -> DataFrame:
    """Reasons to retrain (at most three rows), from the latest report and the calendar."""
    return retraining.retrain_decision(
        retraining.trigger_performance(monitoring.read_windows(report)),
        retraining.trigger_drift(monitoring.read_numeric_drift(report)),
        retraining.trigger_calendar(last_retrained(registry, state), today, "last_retrain"),
        force,
    )


def with_files(row: DataFrame, models_path: str) -> DataFrame:
    """The registry row with algorithm and the places of the model and of its training snapshot."""
    base = F.concat(F.lit(models_path.rstrip("/") + "/"), "version")
    return row.select(
        "*", F.lit(ALGORITHM).alias("algorithm"), base.alias("path"),
        F.concat(F.lit(models_path.rstrip("/") + "/"), "train_snapshot").alias("features_parquet"),
    )


@dataclass(frozen=True)
class Retraining:
    """What a retraining run did: the reasons (none: nothing was trained), and the registry after it."""

    reasons: list[str] = field(default_factory=list)
    promoted: bool = False
    registry: DataFrame | None = None
    comparison: DataFrame | None = None


def retrain(
    features: DataFrame,
    registry: DataFrame,
    report: DataFrame,
    models_path: str,
    today: Column,
    extended_end: str,
    test_start: str,
    state: str | None = None,
    force: bool = False,
    champion_path: str | None = None,
) -> Retraining:
    """Triggers, longer training range, challenger, comparison on the same test slice, promotion.

    ``registry`` is the active model's row, or empty. Without an active model the challenger is promoted.
    Training and test slices have to have rows; a validation slice may be empty. The active model lies under
    ``champion_path`` if that differs from ``models_path``, where the challenger is saved.
    """
    reasons = [row["reason"] for row in decide(report, registry, today, state, force).collect()]
    if not reasons:
        return Retraining(registry=registry)
    spark = features.sparkSession
    split = splits.extended_split(
        splits.labelled(features, contract.LABEL), modeling.TIME, extended_end, test_start
    )
    splits.require_splits(split, (splits.TRAIN, splits.TEST))
    active = registry.first()
    version = registry.select(retraining.next_version(F.col("version"))).first()[0] if active else FIRST_VERSION
    train = sinks.snapshot(split.where(F.col("split") == splits.TRAIN), f"{models_path}/train_{version}")
    challenger = modeling.fit(train, version)
    modeling.save(challenger, models_path)
    held_out = split.where(F.col("split") != splits.TRAIN)
    scores = sinks.overwrite(modeling.labelled_scores(challenger, held_out), fresh_path(spark, "challenger"))
    sizes = splits.split_sizes(split)
    quality = modeling.evaluate(scores, ["split"])
    if active is None:
        row = retraining.registry_row(version, today, extended_end, test_start, sizes, quality)
        return Retraining(reasons, True, with_files(row, models_path))
    champion = modeling.load(spark, champion_path or models_path, active["version"])
    test = split.where(F.col("split") == splits.TEST)
    both = retraining.pair_scores(modeling.labelled_scores(champion, test), scores.where(F.col("split") == splits.TEST))
    comparison = sinks.overwrite(retraining.compare_models(both), fresh_path(spark, "comparison"))
    validation = quality.where(F.col("split") == splits.VALIDATION)
    # one row also where there is no validation slice
    metrics = validation.agg(*[F.max(m).alias(m) for m in retraining.METRICS])
    row = retraining.promote_registry(registry, comparison, sizes, metrics, today, extended_end)
    return Retraining(reasons, comparison.first()["promoted"], with_files(row, models_path), comparison)


def registry_state(spark: SparkSession, registry_path: str, empty: DataFrame) -> tuple[DataFrame, int]:
    """The active model's row (none before the first promotion) and the revision of the registry it was read from."""
    revision = sinks.revision(spark, registry_path)
    if revision == 0:
        return empty.limit(0), 0
    rows = sinks.table(spark, registry_path)
    return rows.orderBy(F.col("registered_as").desc()).limit(1).drop("registered_as"), revision


def register(row: DataFrame, registry_path: str, expected: int) -> DataFrame:
    """Adds the active model's row. The registry must still be at the revision that the run began with; if another run
    has promoted a model since, ``sinks.ReplacedMeanwhile`` is raised and the registry stays as that run left it."""
    spark = row.sparkSession
    numbered = row.withColumn("registered_as", F.lit(expected + 1).cast("bigint"))
    if expected:
        numbered = sinks.table(spark, registry_path).unionByName(numbered)
    return sinks.overwrite(numbered, registry_path, expected)


def retrain_registered(
    features: DataFrame,
    registry_path: str,
    empty: DataFrame,
    report: DataFrame,
    models_path: str,
    today: Column,
    extended_end: str,
    test_start: str,
    state: str | None = None,
    force: bool = False,
) -> Retraining:
    """``retrain`` from and to a stored registry, of which ``empty`` has the columns. Of runs that begin with the same
    registry one promotes its model; the others fail with a message. Every run saves its model in a folder of its own."""
    spark = features.sparkSession
    active, revision = registry_state(spark, registry_path, empty)
    row = active.select("path").first()
    champion = row["path"].rsplit("/", 1)[0] if row else None
    own = f"{models_path.rstrip('/')}/run-{uuid.uuid4().hex}"
    done = retrain(features, active, report, own, today, extended_end, test_start, state, force, champion)
    if not done.promoted:
        return Retraining(done.reasons, False, active, done.comparison)
    register(done.registry, registry_path, revision)
    return Retraining(done.reasons, True, registry_state(spark, registry_path, empty)[0], done.comparison)
