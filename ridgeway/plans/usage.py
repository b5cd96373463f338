"""Daily activity extract and data consumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import predicates as P
from ridgeway.functions.msisdn import canonical
from ridgeway.operators.calendar import slice_periods
from ridgeway.operators.cohort import restrict_to_cohort
from ridgeway.operators.profile import profile

# Columns of the delivered activity file, in its order.
ACTIVITY_COLUMNS = (
    "datedata", "balombeg", "balomend", "nbcashin", "volcashin", "nbcashout",
    "volcashout", "nbcharge", "nbp2pin", "volp2pin", "nbp2pout", "volp2pout",
    "nbmerpay", "volmerpay", "nbbillpay", "volbillpay", "nbotherin", "volotherin",
    "nbotherout", "volotherout", "nbp2pphonein", "nbp2pphoneout", "nbtotalcharge",
    "voltotalcharge", "nbcall", "timecall", "nbsms", "nbcontactcallin",
    "nbcontactcallout", "nbcontactsms", "geoloccomm", "geolocnight",
    "preferedagent", "preferedagentqual", "mmdate", "devicetype", "group_id",
)
COLUMNS_WITHOUT_GROUP = ACTIVITY_COLUMNS[:-1]


def activity_extract(
    activity: DataFrame,
    cohort: DataFrame,
    periods=None,
    key: str = "mmid",
    columns: Sequence[str] = ACTIVITY_COLUMNS,
    day: str = "datedata",
) -> DataFrame:
    """Daily activity rows of the cohort, unaggregated.

    Tables keyed by another column, or without ``group_id``, are read with
    ``key="user_id"`` and ``columns=COLUMNS_WITHOUT_GROUP``.
    """
    sliced, by = slice_periods(activity, day, periods)
    rows = sliced.select(*by, canonical(F.col(key)).alias("mmid"), *columns)
    return restrict_to_cohort(rows, cohort, on="mmid")


def data_usage_profile(
    cdr: DataFrame, cohort: DataFrame, periods=None
) -> DataFrame:
    """Profile of the bytes of every data session per subscriber."""
    sliced, by = slice_periods(cdr, "start_time", periods)
    rows = sliced.where(P.non_zero(F.col("bytes_0"))).select(
        *by, canonical(F.col("billing_nbr")).alias("msisdn"), F.col("bytes_0").alias("bytes")
    )
    rows = restrict_to_cohort(rows, cohort)
    return profile(rows, [*by, "msisdn"], ["bytes"], {"n_sessions": "bytes"})
