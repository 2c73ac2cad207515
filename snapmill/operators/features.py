"""The feature store: attributes with clickstream and financials of the same snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions import derive
from snapmill.operators.joins import HeavyKeys, left_joins


def health_score(debt_ratio: Column, utilisation: Column) -> Column:
    """1 to 5; null inputs score like the worst band."""
    return derive.band_below(debt_ratio, V.DEBT_RATIO_POINTS, V.DEBT_RATIO_POINTS_ELSE) + (
        derive.band_below(utilisation, V.UTILISATION_POINTS, V.UTILISATION_POINTS_ELSE)
    )


def add_scores(features: DataFrame) -> DataFrame:
    return features.withColumns(
        {
            "feature_completeness": derive.share_present(V.COMPLETENESS_COLUMNS),
            "financial_health_score": health_score(
                F.col("Debt_to_income_ratio"), F.col("Credit_Utilization_Ratio")
            ),
        }
    )


def join_features(
    attributes: DataFrame,
    clickstream: DataFrame,
    financials: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Left joins on customer and snapshot, private columns dropped before the shuffle.

    Both joins share the shuffle of the attributes: three exchanges for two joins. ``heavy``
    comes from ``find_heavy_keys`` on the same three inputs.
    """
    people = attributes.drop(*V.PRIVATE_COLUMNS)
    return left_joins(people, [clickstream, financials], heavy=heavy)


def build_features(
    attributes: DataFrame,
    clickstream: DataFrame,
    financials: DataFrame,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    return add_scores(join_features(attributes, clickstream, financials, heavy))
