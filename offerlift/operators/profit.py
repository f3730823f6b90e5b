"""Campaign profit: contacting everyone against contacting the best-scored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TENTHS = tuple(i / 10 for i in range(10))


def profit_curve(
    df: DataFrame,
    gain: float = 100.0,
    cost: float = 10.0,
    thresholds: Sequence[float] = TENTHS,
    score: str = "score",
    label: str = "label",
) -> DataFrame:
    """Profit per threshold: ``gain`` per responder reached, ``cost`` per contact.

    All thresholds are evaluated in one aggregation, so the rows are read once
    and every task ships a single partial row.
    """
    value = F.lit(float(gain)) * F.col(label) - F.lit(float(cost))
    totals = df.agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias("blast"),
        *[
            F.coalesce(F.sum(F.when(F.col(score) >= t, value)), F.lit(0.0)).alias(f"t{i}")
            for i, t in enumerate(thresholds)
        ],
    )
    points = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.round("blast", 6).alias("blast_profit"),
            F.round(f"t{i}", 6).alias("targeted_profit"),
        )
        for i, t in enumerate(thresholds)
    ]
    return totals.select(F.inline(F.array(*points)))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The threshold with the largest uplift over the blast; the lowest on ties."""
    uplift = F.col("targeted_profit") - F.col("blast_profit")
    best = F.max_by(
        F.struct("threshold", "blast_profit", "targeted_profit", uplift.alias("uplift")),
        F.struct(uplift, -F.col("threshold")),
    )
    return curve.agg(best.alias("best")).select("best.*")
