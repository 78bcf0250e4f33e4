"""Readmission risk: train on a hold-out split, report, and score batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from chartmill.operators.metrics import binary_metrics, overfit_gap
from chartmill.operators.models import (
    BoostConfig,
    cross_validate,
    cv_summary,
    feature_importance,
    score,
    train_gbt,
)
from chartmill.operators.sampling import stratified_split


@dataclass
class TrainingReport:
    """A fitted model and its metric tables."""

    model: PipelineModel
    test: DataFrame
    gap: DataFrame
    importance: DataFrame
    folds: DataFrame | None
    cross_validation: DataFrame | None


def train(
    df: DataFrame,
    features: list[str],
    label: str,
    key: str,
    config: BoostConfig = BoostConfig(),
    test_share: float = 0.2,
    folds: int = 5,
) -> TrainingReport:
    """Boosted trees on a stratified training part, with metrics on the rest and over folds."""
    rows = stratified_split(df, label, [1 - test_share, test_share], key, config.seed)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = [rows.where(rows["split"] == i).drop("split") for i in (0, 1)]
        model = train_gbt(parts[0], features, label, config)
        scored = [score(model, part) for part in parts]
        spark = df.sparkSession

        def kept(table: DataFrame) -> DataFrame:
            # One-row and one-row-per-feature tables: held so that the cached rows can go.
            return spark.createDataFrame(table.collect(), table.schema)

        test = kept(binary_metrics(scored[1], label, "p1", "prediction"))
        gap = kept(overfit_gap(scored[0], scored[1], label, "prediction"))
        importance = feature_importance(model, df, features)
        per_fold = None
        if folds:
            per_fold = cross_validate(
                parts[0], lambda t: train_gbt(t, features, label, config), label, key, folds, config.seed
            )
        return TrainingReport(
            model, test, gap, importance, per_fold, cv_summary(per_fold) if per_fold is not None else None
        )
    finally:
        rows.unpersist()
