"""Label normalisation and voting rules (CASE expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def majority_label(pos: Column | str, neu: Column | str, neg: Column | str) -> Column:
    """Strict majority vote: positive only if it beats both others, negative
    likewise; every tie and the all-zero case are neutral."""
    p, u, n = _c(pos), _c(neu), _c(neg)
    return (
        F.when((p > u) & (p > n), F.lit(POSITIVE))
        .when((n > u) & (n > p), F.lit(NEGATIVE))
        .otherwise(F.lit(NEUTRAL))
    )


def normalise_label(label: Column | str, score: Column | str | None = None,
                    rule: str = "identity", *, mapping: dict | None = None,
                    threshold: float = 0.75, negative_label: str = "LABEL_0",
                    positive_label: str = "LABEL_1") -> Column:
    """Map a scorer's raw output to positive / neutral / negative / NULL.

    Rules:
      * ``stars``: '4 stars'/'5 stars' positive, '3 stars' neutral,
        '1 star'/'2 stars' negative, anything else NULL.
      * ``binary_threshold``: the two class labels with ``score >= threshold``
        give negative/positive, below it neutral; other labels NULL.
      * ``binary``: negative_label -> negative, positive_label -> positive,
        anything else neutral.
      * ``signed``: '1' positive, '-1' negative, anything else neutral.
      * ``mapping``: lookup in ``mapping`` (unlisted -> NULL).
      * ``lower``: lower-cased label.
      * ``identity``: the label as is; empty string -> NULL.
    """
    lab = _c(label)
    if rule == "stars":
        return (
            F.when(lab.isin("4 stars", "5 stars"), F.lit(POSITIVE))
            .when(lab == "3 stars", F.lit(NEUTRAL))
            .when(lab.isin("1 star", "2 stars"), F.lit(NEGATIVE))
        )
    if rule == "binary_threshold":
        s = _c(score)
        return (
            F.when((lab == negative_label) & (s >= threshold), F.lit(NEGATIVE))
            .when((lab == positive_label) & (s >= threshold), F.lit(POSITIVE))
            .when(lab.isin(negative_label, positive_label) & (s < threshold), F.lit(NEUTRAL))
        )
    if rule == "binary":
        return (
            F.when(lab == negative_label, F.lit(NEGATIVE))
            .when(lab == positive_label, F.lit(POSITIVE))
            .otherwise(F.lit(NEUTRAL))
        )
    if rule == "signed":
        return (
            F.when(lab == "1", F.lit(POSITIVE))
            .when(lab == "-1", F.lit(NEGATIVE))
            .otherwise(F.lit(NEUTRAL))
        )
    if rule == "mapping":
        expr = None
        for raw, out in (mapping or {}).items():
            expr = F.when(lab == raw, F.lit(out)) if expr is None else expr.when(lab == raw, F.lit(out))
        return expr if expr is not None else F.lit(None).cast("string")
    if rule == "lower":
        return F.lower(lab)
    if rule == "identity":
        return F.when(lab != "", lab)
    raise ValueError(f"unknown label rule: {rule}")
