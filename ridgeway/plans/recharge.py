"""Recharge and subscription jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import labels as L
from ridgeway.functions import predicates as P
from ridgeway.functions.predicates import as_date
from ridgeway.functions.msisdn import canonical, with_country_code
from ridgeway.operators.aggregates import lookup_label, sum_columns
from ridgeway.operators.calendar import slice_periods
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.profile import profile

# The code list of channel types, the delivered status, and the
# amounts a recharge is described by.
CHANNEL_LIST = "DWH_ZB_CHANNEL_TYPE_LV"
DELIVERED = "200"
RECHARGE_AMOUNTS = {
    "amount": "bill_amount",
    "initial_loan": "initial_loan_amount",
    "already_paid_back": "amount_already_pay_back",
    "remain_to_pay_back": "amount_remain_to_pay_back",
}
MONEY = "decimal(30,0)"


def electronic_recharge_profile(
    channel_tx: DataFrame,
    codes: DataFrame,
    cohort: DataFrame,
    periods=None,
    with_year: bool | None = None,
) -> DataFrame:
    """Amount and commission profile per ISO week, subscriber and channel type.

    Week numbers repeat every year. ``year_of_week`` is among the keys if the range may
    span several ISO years (``with_year`` overrides that); a calendar's own keys tell
    its periods apart.
    """
    if with_year is None:
        with_year = periods is None or (
            isinstance(periods, tuple)
            and len({as_date(day).isocalendar().year for day in periods}) > 1
        )
    sliced, by = slice_periods(channel_tx, "transfer_date_time", periods)
    status = F.col("dwh_transfer_status_lv")
    done = sliced.where((status == DELIVERED) & P.not_cancelled(status, ("5", "6")))
    number = with_country_code(F.col("receiver_msisdn").cast("string"))
    rows = done.select(
        *by,
        canonical(number).alias("msisdn"),
        L.iso_week("transfer_date_time").alias("week_nb"),
        L.iso_week_year("transfer_date_time").alias("year_of_week"),
        "dwh_zb_channel_type_lv",
        F.col("transfer_amount").cast(MONEY).alias("transfer_amount"),
        F.col("commision").cast(MONEY).alias("commission"),
    )
    rows = restrict_to_cohort(rows, cohort)
    rows = lookup_label(rows, codes, "dwh_zb_channel_type_lv", CHANNEL_LIST, "type_transaction")
    year = ["year_of_week"] if with_year else []
    return profile(
        rows,
        [*by, *year, "week_nb", "msisdn", "type_transaction"],
        ["transfer_amount", "commission"],
        {"n_transfers": "transfer_amount"}
    )


def recharge_profile(
    recharges: DataFrame,
    cohort: DataFrame,
    periods=None,
    strict_tags: bool = False,
) -> DataFrame:
    """Profile of recharges and emergency loans per subscriber and line type.

    As delivered, a row that is no loan of a tag counts as zero for that tag,
    and ``other_recharge`` describes all rows. ``strict_tags=True`` describes
    each row under its own tag only.
    """
    sliced, by = slice_periods(recharges, "pay_time", periods)
    rows = restrict_to_cohort(sliced.withColumn("msisdn", canonical(F.col("acc_nbr"))), cohort)
    channel, benefit = F.col("contact_channel_id"), F.col("benefit_name")
    is_loan = F.lit(False)
    for tag in filter(None, L.RECHARGE_TAGS.values()):
        is_loan = is_loan | L.tag_match(channel, benefit, tag)

    columns, counts = {}, {}
    for name, tag in L.RECHARGE_TAGS.items():
        belongs = L.tag_match(channel, benefit, tag) if tag else ~is_loan
        for output, source in RECHARGE_AMOUNTS.items():
            value = F.coalesce(F.col(source).cast("double"), F.lit(0.0))
            columns[f"{name}_{output}"] = (
                F.when(belongs, value)
                if strict_tags
                else L.tag_value(channel, benefit, value, tag)
            )
        counts[f"n_{name}"] = f"{name}_amount"
    tagged = rows.select(
        *by,
        "msisdn",
        L.subscriber_label(F.col("subscriber_type_lv")).alias("subscriber_type"),
        *[column.alias(name) for name, column in columns.items()],
    )
    keys = [*by, "msisdn", "subscriber_type"]
    return profile(tagged, keys, list(columns), counts)


def subscription_mix(subscriptions: DataFrame, cohort: DataFrame, periods=None) -> DataFrame:
    """Number of subscriptions of each kind per subscriber and line type."""
    sliced, by = slice_periods(subscriptions, "created_date", periods)
    flags = {
        f"nbr_souscription_{name}": flag
        for name, flag in L.benefit_flags(F.col("benefit_name")).items()
    }
    rows = sliced.select(
        *by,
        canonical(F.col("acc_nbr")).alias("msisdn"),
        L.subscriber_label(F.col("subscriber_type_lv")).alias("subscriber_type"),
        *[flag.alias(name) for name, flag in flags.items()],
    )
    rows = restrict_to_cohort(rows, cohort)
    return sum_columns(rows, [*by, "msisdn", "subscriber_type"], list(flags))
