"""Mobile-money jobs: transaction profile, revenue, transfers, bill payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import predicates as P
from ridgeway.functions.msisdn import canonical
from ridgeway.operators.aggregates import count_and_sum
from ridgeway.operators.calendar import slice_periods
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.profile import profile
from ridgeway.operators.reshape import transfer_sides, two_sided

# Bill types and the codes that tell them apart.
PAY_TV = "CANAL+"
INSURANCE = "PAIEMENT ASSURANCE"
BILL_SERVICE = "FACTURES"
INSURANCE_OFFER = "Financier"
PAY_TV_CATEGORY = "PDVCAPAY"
PAY_TV_DOMAIN = "CAPAY"


def wallet_parties(tx: DataFrame, keep: list[str]) -> DataFrame:
    """Completed transactions, one row per party, with canonical numbers."""

    def side(own: str, other: str, is_send: int) -> dict:
        return {
            "msisdn": canonical(F.col(f"{own}_msisdn")),
            "is_send": F.lit(is_send),
            "user_id": F.col(f"{own}_user_id"),
            "pre_balance": F.col(f"{own}_pre_balance"),
            "post_balance": F.col(f"{own}_post_balance"),
            "category_code": F.col(f"{own}_category_code"),
            "other_category_code": F.col(f"{other}_category_code"),
            "amount": F.col("transaction_amount"),
            "service_charge": F.col("service_charge_amount"),
            "tag": F.col("transaction_tag"),
        }

    done = tx.where(P.completed(F.col("transaction_status"), F.col("rollbacked")))
    return two_sided(
        done, side("sender", "receiver", 1), side("receiver", "sender", 0), keep
    )


def wallet_profile(
    tx: DataFrame, cohort: DataFrame, periods=None
) -> DataFrame:
    """Balance, amount and charge profile per subscriber, role, tag and categories."""
    sliced, by = slice_periods(tx, "transaction_date_time", periods)
    rows = restrict_to_cohort(wallet_parties(sliced, by), cohort)
    keys = [*by, "msisdn", "user_id", "is_send", "tag", "category_code", "other_category_code"]
    metrics = ["pre_balance", "post_balance", "amount", "service_charge"]
    return profile(rows, keys, metrics, {"n_transactions": "pre_balance"})


def wallet_arpu(
    tx: DataFrame, cohort: DataFrame, periods=None
) -> DataFrame:
    """Service-charge profile per subscriber and role."""
    sliced, by = slice_periods(tx, "transaction_date_time", periods)
    done = sliced.where(P.completed(F.col("transaction_status"), F.col("rollbacked")))

    def side(own: str, is_send: int) -> dict:
        return {
            "msisdn": canonical(F.col(f"{own}_msisdn")),
            "is_send": F.lit(is_send),
            "service_charge": F.col("service_charge_amount"),
        }

    rows = restrict_to_cohort(
        two_sided(done, side("sender", 1), side("receiver", 0), by), cohort
    )
    keys = [*by, "msisdn", "is_send"]
    counts = {"n_transactions": "service_charge"}
    return profile(rows, keys, ["service_charge"], counts)


def transfer_profile(
    transfers: DataFrame,
    cohort: DataFrame,
    periods=None,
    per_direction: bool = False,
) -> DataFrame:
    """Airtime-transfer profile per subscriber, received and sent.

    As delivered, a transfer counts as zero on the side the subscriber does not
    play; ``per_direction=True`` leaves those zeros out of every statistic.
    """
    sliced, by = slice_periods(transfers, "transfer_date_time", periods)
    valid = sliced.where(P.not_cancelled(F.col("final_transfer_status_lv")))
    if per_direction:
        nothing = F.lit(None).cast(transfers.schema["transfer_value"].dataType)
        value = F.col("transfer_value")
        rows = two_sided(
            valid,
            {"msisdn": F.col("sender_msisdn"), "transfer_in": nothing, "transfer_out": value},
            {"msisdn": F.col("receiver_msisdn"), "transfer_in": value, "transfer_out": nothing},
            by,
        )
    else:
        rows = transfer_sides(valid, "sender_msisdn", "receiver_msisdn", "transfer_value", by)
    rows = rows.withColumn("msisdn", canonical(F.col("msisdn")))
    rows = restrict_to_cohort(rows, cohort)
    counts = {"n_transfer_in": "transfer_in"}
    if per_direction:
        counts["n_transfer_out"] = "transfer_out"
    return profile(
        rows, [*by, "msisdn"], ["transfer_in", "transfer_out"], counts
    )


def bill_partners(partners: DataFrame) -> DataFrame:
    """Open bill contracts per partner number: the bill types it collects and
    whether it sells insurance. As small as the partner register."""
    open_bills = partners.where(
        (F.col("vas_id") == BILL_SERVICE) & P.open_record(F.col("end_date"))
    )
    insurer = F.col("offer_name") == INSURANCE_OFFER
    return open_bills.groupBy(F.col("msisdn").alias("partner")).agg(
        F.collect_list(F.when(~insurer, F.col("partenaires"))).alias("bill_types"),
        F.max(F.coalesce(insurer, F.lit(False))).alias("sells_insurance"),
    )


def bill_payments(
    tx: DataFrame, partners: DataFrame, cohort: DataFrame, periods=None
) -> DataFrame:
    """Number and amount of bill payments per day, subscriber and bill type.

    The three kinds of bill share one scan, one join to the partner register
    and one aggregate: each transaction lists the bill types it pays for.
    """
    sliced, _ = slice_periods(tx, "transaction_date_time", periods)
    paid = sliced.where(F.col("transaction_status") == P.COMPLETED).withColumn(
        "msisdn", canonical(F.col("sender_msisdn"))
    )
    paid = restrict_to_cohort(paid, cohort)
    joined = paid.join(
        bill_partners(partners), F.col("receiver_msisdn") == F.col("partner"), "left"
    )
    category, domain = F.col("receiver_category_code"), F.col("receiver_domain_code")
    nothing = F.array().cast("array<string>")
    pay_tv = (category == PAY_TV_CATEGORY) & (domain == PAY_TV_DOMAIN) & (F.col("commission_oca") > 0)
    other = (category != PAY_TV_CATEGORY) & (domain != PAY_TV_DOMAIN)
    types = F.concat(
        F.when(pay_tv, F.array(F.lit(PAY_TV))).otherwise(nothing),
        F.when(other, F.coalesce("bill_types", nothing)).otherwise(nothing),
        F.when(F.col("sells_insurance"), F.array(F.lit(INSURANCE))).otherwise(nothing),
    )
    rows = joined.select(
        F.to_date("transaction_date_time").alias("period"),
        "msisdn",
        F.explode(types).alias("type_facture"),
        "transaction_amount",
    )
    return count_and_sum(rows, ["period", "msisdn", "type_facture"], "transaction_amount")
