"""Snapshot jobs: value segments, multi-SIM flags, fleet flag, location."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import labels as L
from ridgeway.functions import predicates as P
from ridgeway.functions.msisdn import by_length, by_operator_class, canonical
from ridgeway.operators.aggregates import flag_max, indicator
from ridgeway.operators.calendar import MONTH_ID, slice_snapshots
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.reshape import union_all

# Client types and profile patterns of the fleet flag, and the
# delivered place names.
FLEET_TYPES = ("HYBRIDE", "POSTPAID", "HYBRID")
FLEET_EXCLUDED = ("%SP%BR_NOVA%", "%SP%COMMUNITY%")
PLACE_COLUMNS = {
    "zone_commerciale": "zone_commerciale",
    "nom_region": "region",
    "nom_depart": "departement",
    "unite_administrative": "commune",
    "geolocalite": "geolocalite",
    "quartier": "quartier",
}


def value_segments(
    values: DataFrame,
    terminals: DataFrame,
    cohort: DataFrame,
    month: DataFrame | str | None = None,
) -> DataFrame:
    """Spend, tariff, wallet-use and terminal segments per subscriber and month.

    ``month`` is one month, a calendar of months, or ``None`` for every month of both
    tables. The cohort is applied to both sides before they are joined.
    """

    def prepared(df: DataFrame) -> DataFrame:
        df = slice_snapshots(df, "month_id", month, MONTH_ID)
        numbered = df.withColumn("number", by_length(F.col("msisdn")))
        numbered = numbered.where(F.col("number").isNotNull())
        return restrict_to_cohort(
            numbered.withColumn("msisdn", canonical(F.col("number"))), cohort
        )

    spend = F.col("conso_cp_tot") + F.col("conso_forfait_tot")
    wallet_spend = F.col("conso_cp_tot_pass_via_om") + F.col("conso_forf_tot_pass_via_om")
    recharge = F.col("om_rc_amount") + F.col("rc_montant_tot")
    valued = prepared(values).select(
        "number",
        "msisdn",
        "month_id",
        L.value_band(spend).alias("segment_valeur"),
        L.tariff_family(F.col("profil_endperiod"), F.col("type_client_endperiod")).alias(
            "plan_tarifaire"
        ),
        L.kb_to_mb(F.col("vol_tot_data_ko")).alias("trafic_data_mo"),
        spend.alias("arpu_telco"),
        F.col("nb_tot_pass_data").alias("nb_pass_data"),
        (F.col("conso_cp_tot_pass_data") + F.col("conso_forfait_tot_pass_data")).alias("arpu_data"),
        F.col("nb_tot_pass_ix").alias("nb_pass_mix"),
        (F.col("conso_cp_tot_pass_ix") + F.col("conso_forfait_tot_pass_ix")).alias("arpu_mix"),
        L.ratio_band(wallet_spend, recharge).alias("taux_usage_om"),
    )
    handsets = prepared(terminals).select(
        "number",
        "month_id",
        L.terminal_generation(F.col("type_terminal"), F.col("vol_4g_ota_mo")).alias(
            "type_terminal"
        ),
    )
    return valued.join(handsets, ["number", "month_id"]).drop("number")


def network_flags(
    registry_a: DataFrame,
    registry_b: DataFrame,
    cohort: DataFrame,
    home: str,
    others: Mapping[str, str],
) -> DataFrame:
    """Per subscriber, on which networks a SIM is known to be held.

    ``home`` names the own network and ``others`` maps each other network to its
    code in the second registry; the names end the flag columns (``statut_<name>``
    read from the first registry, ``statut_msim_<name>`` delivered).

    The registries have different grain; both become one row per entry with a
    flag per network, and one maximum settles inner and outer grouping at once.
    """
    number = by_operator_class(F.col("msisdn"), strict=True).alias("msisdn")
    networks = [home, *others]
    first = registry_a.select(
        number, *[F.col(f"statut_{n}").cast("int").alias(f"statut_msim_{n}") for n in networks]
    )
    second = registry_b.select(
        number,
        indicator(F.col("top_ds_on") == 1).alias(f"statut_msim_{home}"),
        *[
            indicator(F.col("op_offnet") == code).alias(f"statut_msim_{n}")
            for n, code in others.items()
        ],
    )
    rows = restrict_to_cohort(union_all(first, second), cohort)
    return flag_max(rows, ["msisdn"], [f"statut_msim_{n}" for n in networks])


def fleet_flag(
    fleet: DataFrame, cohort: DataFrame, day: DataFrame | str | None = None
) -> DataFrame:
    """Whether a corporate line uses its fleet calls, per subscriber and day.

    ``day`` is one day, a calendar of days, or ``None`` for all.
    """
    rows = slice_snapshots(fleet, "date_id", day).where(
        F.col("type_client_endperiod").isin(*FLEET_TYPES)
        & P.not_like_any(F.col("profil_endperiod"), FLEET_EXCLUDED)
    ).select(
        canonical(F.col("msisdn")).alias("msisdn"),
        L.positive_flag(F.col("vol_tot_voix_intra_fl")).alias("statut_flotte_entreprise"),
        "date_id",
    )
    return restrict_to_cohort(rows, cohort)


def geo_location(
    places: DataFrame, cohort: DataFrame, day: DataFrame | str | None = None
) -> DataFrame:
    """Where a subscriber lives, per day; ``day`` as for :func:`fleet_flag`."""
    rows = slice_snapshots(places, "date_id", day)
    rows = rows.select(
        canonical(F.col("msisdn")).alias("msisdn"),
        *[F.col(source).alias(name) for source, name in PLACE_COLUMNS.items()],
        "date_id",
    )
    return restrict_to_cohort(rows, cohort)
