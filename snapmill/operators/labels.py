"""Default labels and the bad-rate curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill import fixed_values as V
from snapmill.functions.calendar import DateLike, day
from snapmill.functions.derive import reached


def label_definition(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"


def default_labels(loans: DataFrame, dpd: int = V.LABEL_DPD, mob: int = V.LABEL_MOB) -> DataFrame:
    """Label of every loan row at the given month on book.

    Read ``loans`` from the stored table when it exists: the filter on ``mob`` then reaches
    the Parquet scan, and only six columns are read.
    """
    return loans.where(F.col("mob") == mob).select(
        "loan_id",
        V.ENTITY,
        reached(F.col("dpd"), dpd).alias("label"),
        F.lit(label_definition(dpd, mob)).alias("label_def"),
        V.SNAPSHOT,
    )


def labels_by_definition(loans: DataFrame, definitions: Sequence[tuple[int, int]]) -> DataFrame:
    """Labels of every loan row under each definition (dpd, mob) whose month on book it is at.

    One scan however many definitions there are: a row is repeated for those of its month only,
    and rows of other months are left out in the scan.
    """
    if not definitions:
        raise ValueError("no label definition given")
    if len(definitions) == 1:
        return default_labels(loans, *definitions[0])
    listed = F.array(
        *[F.struct(F.lit(d).alias("dpd"), F.lit(m).alias("mob"), F.lit(label_definition(d, m)).alias("name")) for d, m in definitions]
    )
    own = F.filter(listed, lambda d: d["mob"] == F.col("mob"))
    at = loans.where(F.col("mob").isin(*{m for _, m in definitions})).select(
        "loan_id", V.ENTITY, "dpd", V.SNAPSHOT, F.explode(own).alias("definition")
    )
    return at.select(
        "loan_id",
        V.ENTITY,
        reached(F.col("dpd"), F.col("definition.dpd")).alias("label"),
        F.col("definition.name").alias("label_def"),
        V.SNAPSHOT,
    )


def closed_cohort(
    loans: DataFrame, cutoff: DateLike = V.COHORT_CUTOFF, dpd: int = V.LABEL_DPD
) -> DataFrame:
    """Loans started before the cutoff, flagged when past due by ``dpd`` days or more."""
    old = loans.where(F.col("loan_start_date") < F.lit(day(cutoff)))
    return old.withColumn("dpd_flag", reached(F.col("dpd"), dpd))


def final_installments(loans: DataFrame, number: int = V.FINAL_INSTALLMENT) -> DataFrame:
    return loans.where(F.col("installment_num") == number)


def bad_rate_by_mob(
    loans: DataFrame, cutoff: DateLike = V.COHORT_CUTOFF, dpd: int = V.LABEL_DPD
) -> DataFrame:
    """Share of flagged rows per month on book, in month order."""
    flagged = closed_cohort(loans, cutoff, dpd)
    return flagged.groupBy("mob").agg(F.avg("dpd_flag").alias("bad_rate")).orderBy("mob")
