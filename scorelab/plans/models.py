"""Segmentation and classification of scored responses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelab import vocabulary as V
from scorelab.operators import classify as C
from scorelab.operators import clustering as K
from scorelab.operators import deep_forest as D
from scorelab.operators import metrics as M
from scorelab.operators.sampling import mark_test_rows
from scorelab.operators.scores import TRUST, USAGE
from scorelab.operators.segments import add_label, score_cuts
from scorelab.session import materialise


def model_rows(scored: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Labelled rows with every model column known; stays distributed."""
    columns = [*V.CLUSTER_FEATURES, V.LABEL]
    return add_label(scored, cuts).select(V.KEY, *columns).dropna(subset=columns)


def cluster_vectors(scored: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    return K.standardized_vectors(model_rows(scored, cuts), V.CLUSTER_FEATURES, [V.KEY, V.LABEL])


def segment(vectors: DataFrame, k: int = 4, seed: int = 42, starts: int = 10, fitted: dict | None = None) -> DataFrame:
    """Rows with a canonical cluster id, by a model of ``fitted`` (k: model) or a fit of its own."""
    fitted = fitted or K.best_kmeans(vectors, V.KEY, [k], seed, starts)
    return K.assign_clusters(vectors, fitted[k])


def label_lineage(allowed: Sequence[str] = V.PREDICTORS) -> list[str]:
    """Scores behind the label and their components, but for usage inputs that are ``allowed`` by name."""
    inputs = {c.column for c in USAGE.components}
    # A capped count is its count as far as a model is concerned.
    inputs |= {c.removesuffix("Capped") for c in inputs}
    hidden = {USAGE.name, TRUST.name, *(c.column for c in TRUST.components), *(inputs - set(allowed))}
    return sorted(hidden)


@dataclass(frozen=True)
class Evaluated:
    """An evaluated ensemble: everything a report needs, as DataFrames."""

    predictions: DataFrame
    importance: DataFrame
    record: DataFrame
    confusion: DataFrame
    report: DataFrame
    strip: DataFrame
    ensemble: C.Ensemble


def classify(
    scored: DataFrame,
    fraction: str = "0.2",
    seed: int = 42,
    seeds: Sequence[int] = tuple(V.FOREST_SEEDS),
    trees: int = 200,
    depth: int | None = None,
) -> Evaluated:
    """Predict the focus quadrant, by trees without a limit unless ``depth`` sets one.

    No trust component is a predictor.  Usage inputs are, on purpose: the question is
    which habits go with low trust among heavy users, so their share in the label is known.
    """
    cuts = score_cuts(scored)
    marked = materialise(mark_test_rows(model_rows(scored, cuts), V.LABEL, V.KEY, fraction, seed), "split")
    train, test = marked.where(~F.col("is_test")), marked.where("is_test")
    asked = test.select(V.KEY, *V.PREDICTORS, V.LABEL)
    if depth is None:
        ensemble = D.fit_deep_ensemble(train, V.PREDICTORS, V.LABEL, seeds, trees, label_lineage(), key=V.KEY)
        voted, importance = D.vote_deep(ensemble, asked), D.deep_importance(ensemble, scored.sparkSession)
    else:
        ensemble = C.fit_ensemble(train, V.PREDICTORS, V.LABEL, seeds, trees, depth, label_lineage(), key=V.KEY)
        voted, importance = C.vote(ensemble, asked), C.feature_importance(ensemble, scored.sparkSession)
    # Three forests per row are worth computing once.
    predictions = materialise(voted.drop(V.LABEL), "predictions")
    return Evaluated(
        predictions=predictions,
        importance=importance,
        record=C.metrics_record(predictions, train, V.LABEL, cuts, V.PREDICTORS),
        confusion=M.confusion_matrix(predictions, "y_true", "y_pred"),
        report=M.classification_report(predictions, "y_true", "y_pred"),
        strip=evaluation_strip(predictions),
        ensemble=ensemble,
    )


def evaluation_strip(predictions: DataFrame) -> DataFrame:
    """Accuracy, baseline, balanced accuracy, precision, recall, F1 and AUC in one row."""
    auc = M.roc_auc(predictions, "y_true", "y_proba").agg(F.max("roc_auc")).scalar()
    return M.binary_metrics(predictions, "y_true", "y_pred").withColumn("roc_auc", auc)
