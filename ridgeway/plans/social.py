"""Social-graph jobs on wallet transfers and telecom records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.functions import labels as L
from ridgeway.functions import predicates as P
from ridgeway.functions.msisdn import canonical, canonical_if_local
from ridgeway.operators.calendar import period_literals, slice_periods
from ridgeway.operators.cohort import distinct_cohort, restrict_to_cohort
from ridgeway.operators.graph import in_out_profile, peer_statistics
from ridgeway.operators.lineage import materialise
from ridgeway.operators.panes import Measure, aggregate_periods
from ridgeway.operators.profile import profile
from ridgeway.operators.triangles import with_triangles

# The customer category of private persons, the universe of the
# mobile graphs, and the services that have two ends.
SUBSCRIBER = "SUBS"
MOBILE = "MOBILE"
MOBILE_CODE = 2
MESSAGE_SERVICE = 3
CATEGORIES = ("local", "inter", "roaming")
GRAPH_SERVICES = {"SMS": "nbr_exch_sms", "VOIX": "total_duration_voix"}
TABLE_SERVICES = ("DATA", "SVA", "IMS", "UNKNOWN")


def wallet_edges(
    tx: DataFrame, tag: str | None = None, periods=None
) -> tuple[DataFrame, list[str]]:
    """Person-to-person transfers summed per sender, receiver and tag, and the names of
    the period columns.

    Numbers are normalised first: a subscriber written in two ways is one vertex.
    Overlapping periods share one read and one shuffle of the transfers.
    """
    person = P.both_in(F.col("sender_category_code"), F.col("receiver_category_code"), SUBSCRIBER)
    rows = tx.where(
        P.all_of(
            P.completed(F.col("transaction_status"), F.col("rollbacked")),
            person,
            P.equals_if(F.col("transaction_tag"), tag),
        )
    )
    amount, charge = F.col("transaction_amount"), F.col("service_charge_amount")
    ends = {"src": canonical(F.col("sender_msisdn")), "dst": canonical(F.col("receiver_msisdn"))}
    return aggregate_periods(
        rows.withColumns(ends),
        "transaction_date_time",
        periods,
        ["transaction_tag", *ends],
        {
            "nbr_transactions": Measure("count", amount),
            "total_transaction": Measure("sum", amount),
            "nbr_service_charge": Measure("count", charge),
            "total_service_charge": Measure("sum", charge),
        },
    )


def wallet_graph_indicators(
    tx: DataFrame,
    cohort: DataFrame,
    periods=None,
    tag: str | None = None,
) -> DataFrame:
    """In/out amounts, degrees and triangles of every two-way subscriber."""
    summed, by = wallet_edges(tx, tag, periods)
    edges = materialise(summed.select(*by, "src", "dst", "total_transaction"))
    sides = in_out_profile(edges, "total_transaction", by)
    indicators = with_triangles(sides, edges, by)
    return restrict_to_cohort(indicators.withColumnRenamed("id", "msisdn"), cohort)


def telecom_records(cdr: DataFrame, extensions: DataFrame, events: DataFrame) -> DataFrame:
    """Call records with readable codes; both dimensions also act as filters."""
    prefixes = extensions.select(F.col("dwh_extension_id").alias("called_prefix_id"))
    kinds = events.select("re_id", F.col("re_category_lv").alias("categorie"))
    slots = range(1, 5)
    charge = L.account_charge(
        [F.col(f"acct_res_id{i}") for i in slots], [F.col(f"charge{i}") for i in slots]
    )
    return (
        cdr.join(prefixes, "called_prefix_id", "left_semi")
        .join(kinds, "re_id")
        .select(
            canonical_if_local(F.col("calling_nbr")).alias("src"),
            canonical_if_local(F.col("called_nbr")).alias("dst"),
            canonical(F.col("billing_nbr")).alias("msisdn"),
            L.service_label(F.col("service_type_lv")).alias("service"),
            L.universe_label(F.col("dim_universe_lv")).alias("universe"),
            F.col("service_type_lv").alias("service_code"),
            F.col("dim_universe_lv").alias("universe_code"),
            "re_id",
            "categorie",
            "duration",
            F.col("bytes_0").alias("bytes"),
            charge.alias("conso_mb"),
            "start_time",
        )
    )


def _members(categories: Sequence[str]) -> dict[str, Column]:
    """Per category the condition that a record belongs to it; ``local`` takes all."""
    found = {name: P.in_category(F.col("categorie"), name) for name in categories}
    return {name: F.lit(True) if c is None else c for name, c in found.items()}


def by_category(records: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """One row per traffic category a record belongs to; ``local`` takes all.

    All categories come from one scan instead of one run each.
    """
    member = [F.when(condition, name) for name, condition in _members(categories).items()]
    return records.withColumn(
        "category", F.explode(F.array_compact(F.array(*member)))
    )


def category_edges(
    records: DataFrame,
    src: Column,
    dst: Column,
    weight: Measure,
    categories: Sequence[str] = CATEGORIES,
    periods=None,
) -> tuple[DataFrame, list[str]]:
    """``src, dst, category, weight`` (and period) of the edges of every category, and the
    names of the period columns.

    Each category is a conditional aggregate of the same rows; they become rows of their
    own after the shuffle, so that no record is copied before it. An edge without a
    record in a category has no row there; records count, whatever their weight is.
    """
    measures = {}
    for name, condition in _members(categories).items():
        measures[f"n_{name}"] = Measure("count", F.when(condition, 1))
        measures[f"weight_{name}"] = Measure(weight.kind, F.when(condition, weight.column))
    ends = records.withColumns({"src": src, "dst": dst})
    summed, by = aggregate_periods(ends, "start_time", periods, ["src", "dst"], measures)
    each = [
        F.when(
            F.col(f"n_{name}") > 0,
            F.struct(F.lit(name).alias("category"), F.col(f"weight_{name}").alias("weight")),
        )
        for name in categories
    ]
    rows = summed.select(*by, "src", "dst", F.inline(F.array_compact(F.array(*each))))
    return rows, by


def telecom_indicators(
    records: DataFrame,
    cohort: DataFrame,
    service: str,
    periods=None,
    categories: Sequence[str] = CATEGORIES,
    re_id: str | None = None,
    universe: str | None = MOBILE,
) -> DataFrame:
    """Indicators of one service, per category and subscriber.

    SMS and voice give peer statistics, data a byte and charge profile, the
    other services a number of events. Service and universe are filtered by their
    codes, so that the scan of the records can skip the others.
    """
    if service not in (*GRAPH_SERVICES, *TABLE_SERVICES):
        raise ValueError(f"unknown service {service!r}")
    rows = records.where(
        P.all_of(
            L.has_label(F.col("service_code"), L.SERVICES, service),
            P.equals_if(F.col("re_id"), re_id),
            universe and L.has_label(F.col("universe_code"), L.UNIVERSES, universe),
        )
    )
    if service in GRAPH_SERVICES:
        label = GRAPH_SERVICES[service]
        weight = Measure("sum", F.col("duration")) if service == "VOIX" else Measure("count", F.col("service"))
        found, by = category_edges(rows, F.col("src"), F.col("dst"), weight, categories, periods)
        by = [*by, "category"]
        edges = materialise(found)

        def of_cohort(end: str) -> DataFrame:
            mine = restrict_to_cohort(edges.withColumnRenamed(end, "msisdn"), cohort)
            return mine.withColumnRenamed("msisdn", end)

        stats = peer_statistics(of_cohort("src"), of_cohort("dst"), "weight", label, by)
        return stats.withColumnRenamed("id", "msisdn")
    mine = restrict_to_cohort(rows, cohort)
    if service == "DATA":
        sliced, by = slice_periods(mine, "start_time", periods)
        return profile(
            by_category(sliced, categories),
            [*by, "category", "msisdn"],
            ["bytes", "conso_mb"],
            {"n_exch_data": "bytes"},
            sums=True
        )
    counts = {name: Measure("count", F.when(c, 1)) for name, c in _members(categories).items()}
    counted, by = aggregate_periods(mine, "start_time", periods, ["msisdn"], counts)
    number = f"nbr_exch_{service.lower()}"
    each = [
        F.when(F.col(name) > 0, F.struct(F.lit(name).alias("category"), F.col(name).alias(number)))
        for name in categories
    ]
    return counted.select(*by, "msisdn", F.inline(F.array_compact(F.array(*each)))).select(
        *by, "category", "msisdn", number
    )


def message_profile(
    cdr: DataFrame,
    extensions: DataFrame,
    events: DataFrame,
    cohort: DataFrame,
    periods=None,
    service_code: int = MESSAGE_SERVICE,
    categories: Sequence[str] = CATEGORIES,
    re_id: str | None = None,
) -> DataFrame:
    """Exchanges per peer, received and sent, for every cohort member.

    Members without traffic keep a row with NULL statistics, per category.
    """
    prefixes = extensions.select(F.col("dwh_extension_id").alias("called_prefix_id"))
    kinds = events.select("re_id", F.col("re_category_lv").alias("categorie"))
    rows = (
        cdr.where(
            P.all_of(
                F.col("dim_universe_lv") == MOBILE_CODE,
                F.col("service_type_lv") == service_code,
                P.equals_if(F.col("re_id"), re_id),
            )
        )
        .join(prefixes, "called_prefix_id", "left_semi")
        .join(kinds, "re_id")
    )
    ends = (canonical_if_local(F.col("calling_nbr")), canonical_if_local(F.col("called_nbr")))
    found, by = category_edges(rows, *ends, Measure("count", F.lit(1)), categories, periods)
    by = [*by, "category"]
    edges = materialise(found.withColumnRenamed("weight", "exchanges"))

    def one_side(own: str, peer: str, side: str, count: str) -> DataFrame:
        mine = restrict_to_cohort(edges.withColumnRenamed(own, "msisdn"), cohort)
        weighted = mine.withColumnRenamed("exchanges", f"msg_{side}")
        return profile(
            weighted, [*by, "msisdn"], [f"msg_{side}"], {count: peer}, sums=True
        )

    received = one_side("dst", "src", "in", "nbr_src")
    sent = one_side("src", "dst", "out", "nbr_dst")
    frame = distinct_cohort(cohort).withColumnRenamed("phone", "msisdn")
    if len(by) > 1:
        frame = frame.select("*", F.inline(period_literals(periods)))
    frame = frame.withColumn("category", F.explode(F.array(*[F.lit(c) for c in categories])))
    return frame.join(received, [*by, "msisdn"], "left").join(sent, [*by, "msisdn"], "left")
