"""Fixed-line customer bases matched to the cohort by contact number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions.msisdn import by_operator_class
from ridgeway.operators.calendar import slice_snapshots
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.reshape import explode_contacts

def _day_column(day: DataFrame | str | None) -> list[str]:
    return ["date_jour"] if isinstance(day, DataFrame) else []


def wireless_base(
    lines: DataFrame, cohort: DataFrame, kind: str, day: DataFrame | str | None = None
) -> DataFrame:
    """FDD or TDD lines with one contact; ``kind`` fills the speed column.

    ``day`` is one day, a calendar of days, or ``None`` for all; ``date_jour`` tells the
    days apart where there are several.
    """
    rows = slice_snapshots(lines, "date_jour", day).select(
        *_day_column(day),
        by_operator_class(F.col("second_contact")).alias("msisdn"),
        "plan_tarifaire",
        F.lit(kind).alias("debit"),
        F.col("categorie_offre").alias("categorie"),
        "categorie_client",
        "ville",
        F.col("nd").alias("numero"),
    )
    return restrict_to_cohort(rows, cohort)


def wired_base(
    lines: DataFrame,
    cohort: DataFrame,
    day: DataFrame | str | None = None,
    client_category: str = "categorie_client",
    number: str = "nd",
) -> DataFrame:
    """ADSL or FTTH lines: one row per contact number found in the cohort; ``day`` as for
    :func:`wireless_base`."""
    rows = explode_contacts(
        slice_snapshots(lines, "date_jour", day),
        [by_operator_class(F.col("contact")), by_operator_class(F.col("second_contact"))],
    ).select(
        *_day_column(day),
        "msisdn",
        "plan_tarifaire",
        "debit",
        "categorie",
        F.col(client_category).alias("categorie_client"),
        "etat",
        "ville",
        F.col(number).alias("numero"),
    )
    return restrict_to_cohort(rows, cohort)
