"""Registered queries: every job and operator on whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness import sources as S
from harness.usage_features import centroids, usage_features
from ridgeway.functions import labels as L
from ridgeway.functions import msisdn as N
from ridgeway.functions import predicates as P
from ridgeway.functions.usage import MODEL_FEATURES
from ridgeway.operators import calendar as C
from ridgeway.operators import graph as G
from ridgeway.operators import reshape as R
from ridgeway.operators import segment as M
from ridgeway.operators import states as T
from ridgeway.operators.aggregates import count_and_sum, event_count, lookup_label
from ridgeway.operators.cohort import SIEVE_WORDS, complete_with_cohort, restrict_to_cohort
from ridgeway.operators.lineage import shared_base
from ridgeway.operators.profile import profile
from ridgeway.operators.triangles import with_triangles
from ridgeway.plans import lines, recharge, segments, social, subscribers, usage, wallet
from ridgeway.sources import files

# The day range spans all order dates, so the filter runs and every row counts.
ALL_DAYS = ("19950101", "20011231")
ALL_EVENTS = ("20240101", "20241231")
LAST_SUNDAY = "20010805"
SNAPSHOT = "20240102"
ALL_WEEKS = 345

Query = Callable[[SparkSession, str], DataFrame]


def stable(df: DataFrame) -> DataFrame:
    """Round fractions for comparison across engines: two digits, exact ties
    nudged upwards so that summation order cannot decide them."""
    shown = []
    for field in df.schema:
        name, kind = f"`{field.name}`", field.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            shown.append(f"round(CAST({name} AS DOUBLE) + 1e-6D, 2) AS {name}")
        elif kind == "date":
            shown.append(f"date_format({name}, '{C.DAY_ID}') AS {name}")
        else:
            shown.append(name)
    return df.selectExpr(*shown)


# -- profile jobs -----------------------------------------------------------
def wallet_profile(spark, sf):
    return wallet.wallet_profile(S.wallet_tx(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def wallet_arpu(spark, sf):
    return wallet.wallet_arpu(S.wallet_tx(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def profile_large_groups(spark, sf):
    """Three groups that hold all rows, each met in many pieces."""
    rows = S.read(spark, sf, "lineitem").repartition(8, "l_orderkey")
    return profile(
        rows, ["l_returnflag"], ["l_extendedprice", "l_tax"], {"n_lines": "l_orderkey"},
        sums=True, most_listed=0,
    )


def transfer_profile(spark, sf):
    return wallet.transfer_profile(S.credit_transfers(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def transfer_profile_per_direction(spark, sf):
    return wallet.transfer_profile(
        S.credit_transfers(spark, sf), S.cohort(spark, sf), ALL_DAYS, per_direction=True
    )


def recharge_weekly_profile(spark, sf):
    return recharge.electronic_recharge_profile(
        S.channel_tx(spark, sf), S.code_list(spark, sf), S.cohort(spark, sf), ALL_EVENTS
    )


def recharge_tag_profile(spark, sf):
    return recharge.recharge_profile(S.recharges(spark, sf), S.cohort(spark, sf), ALL_EVENTS)


def recharge_strict_tag_profile(spark, sf):
    return recharge.recharge_profile(
        S.recharges(spark, sf), S.cohort(spark, sf), ALL_EVENTS, strict_tags=True
    )


def subscription_mix(spark, sf):
    return recharge.subscription_mix(S.subscriptions(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def activity_extract(spark, sf):
    events = S.read(spark, sf, "events").withColumn("user_key", S.short_number("user_id"))
    return usage.activity_extract(
        events,
        S.cohort(spark, sf),
        ALL_EVENTS,
        key="user_key",
        columns=["event_id", "event_type", "value"],
        day="ts",
    )


def data_usage_profile(spark, sf):
    return usage.data_usage_profile(S.cdr(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def bill_payments(spark, sf):
    return wallet.bill_payments(
        S.wallet_tx(spark, sf), S.partners(spark, sf), S.cohort(spark, sf), ALL_DAYS
    )


# -- files ------------------------------------------------------------------
def _folder(spark, name):
    """A new folder for a round trip, below the session's shared one if it has any."""
    return files.result_path(f"{shared_base(spark).rstrip('/')}/{uuid.uuid4().hex}", name)


def file_partitioned_csv(spark, sf):
    """Four weeks of activity, written with a header per period and read again."""
    periods = C.plan_periods(spark, "history", end="20240128", depth=4)
    rows = usage.activity_extract(
        S.activity(spark, sf), S.cohort(spark, sf), periods, columns=["datedata", "nbcashin", "volcashin"]
    )
    path = _folder(spark, "activity")
    files.write_table(files.with_period_name(rows), path, ("period",))
    back = spark.read.option("header", True).csv(path)
    return back.groupBy(F.col("period").cast("string").alias("period")).agg(
        F.count("mmid").alias("n_rows"), F.sum(F.col("volcashin").cast("bigint")).alias("total")
    )


def file_published(spark, sf):
    """Four weeks of activity in two overlapping deliveries, each visible as a whole."""
    path = _folder(spark, "published")
    for end, depth in (("20240121", 3), ("20240128", 2)):
        periods = C.plan_periods(spark, "history", end=end, depth=depth)
        rows = usage.activity_extract(
            S.activity(spark, sf), S.cohort(spark, sf), periods, columns=["datedata", "nbcashin", "volcashin"]
        )
        files.publish(files.with_period_name(rows), path, "period")
    back = files.read_published(spark, path)
    return back.groupBy("period").agg(
        F.count("mmid").alias("n_rows"), F.sum(F.col("volcashin").cast("bigint")).alias("total")
    )


def file_plain_csv(spark, sf):
    """Headerless part files, read again by position."""
    path = _folder(spark, "locations")
    found = geo_location(spark, sf).select("msisdn", "region", "quartier")
    files.write_plain_csv(found, path)
    back = spark.read.schema("msisdn string, region string, quartier string").csv(path)
    return back.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("msisdn").alias("first_msisdn")
    )


def file_cohort(spark, sf):
    """A client list with repeated rows, read as a cohort."""
    path = _folder(spark, "clients")
    clients = S.cohort(spark, sf).select(F.col("phone").alias("Phone"), F.lit("x").alias("Name"))
    clients.union(clients).write.option("header", True).option("sep", ";").csv(path)
    cohort = files.read_cohort(spark, path)
    return cohort.agg(
        F.count("phone").alias("n_clients"), F.min("phone").alias("first"), F.max("phone").alias("last")
    )


# -- snapshot jobs ----------------------------------------------------------
def value_segments(spark, sf):
    return subscribers.value_segments(
        S.value_datamart(spark, sf), S.terminal_datamart(spark, sf), S.cohort(spark, sf)
    )


def multi_flag(spark, sf):
    return subscribers.network_flags(
        S.sim_registry_a(spark, sf), S.sim_registry_b(spark, sf), S.line_cohort(spark, sf),
        home="home", others={"alpha": "ALPHA", "beta": "BETA"},
    )


def fleet_flag(spark, sf):
    return subscribers.fleet_flag(S.fleet_datamart(spark, sf), S.cohort(spark, sf))


def geo_location(spark, sf):
    return subscribers.geo_location(
        S.location_datamart(spark, sf), S.cohort(spark, sf), SNAPSHOT
    )


def line_base_one_contact(spark, sf):
    return lines.wireless_base(S.fixed_lines(spark, sf), S.line_cohort(spark, sf), "FDD", SNAPSHOT)


def line_base_tdd(spark, sf):
    return lines.wireless_base(S.fixed_lines(spark, sf), S.line_cohort(spark, sf), "TDD", "20240103")


def line_base_two_contacts(spark, sf):
    return lines.wired_base(S.fixed_lines(spark, sf), S.line_cohort(spark, sf), SNAPSHOT)


def line_base_ftth(spark, sf):
    """Fibre lines name their client category and number in columns of their own."""
    rows = S.fixed_lines(spark, sf).withColumnsRenamed({"categorie_client": "segment", "nd": "login"})
    return lines.wired_base(rows, S.line_cohort(spark, sf), "20240103", "segment", "login")


def backfill_locations(spark, sf):
    """Day-keyed snapshots for the last two of three days."""
    periods = C.plan_periods(spark, "history", end="20240104", unit="day", depth=2)
    return subscribers.geo_location(S.location_datamart(spark, sf), S.cohort(spark, sf), periods)


def backfill_value_segments(spark, sf):
    """Month-keyed snapshots, the later of two months."""
    periods = C.plan_periods(spark, "history", end="20240331", unit="month", depth=2)
    return subscribers.value_segments(
        S.value_datamart(spark, sf), S.terminal_datamart(spark, sf), S.cohort(spark, sf), periods
    )


def backfill_wallet_arpu(spark, sf):
    """An event job over ten of the weeks."""
    periods = C.plan_periods(spark, "history", end="19980614", depth=10)
    return wallet.wallet_arpu(S.wallet_tx(spark, sf), S.cohort(spark, sf), periods)


def history_telecom_sms(spark, sf):
    """The telecom graph over its 59 weeks of history."""
    periods = C.plan_periods(spark, "history", end="19980614", depth=C.HISTORY_WEEKS)
    return social.telecom_indicators(_records(spark, sf), S.cohort(spark, sf), "SMS", periods)


def history_telecom_data(spark, sf):
    """Data sessions over the 59 weeks of history."""
    periods = C.plan_periods(spark, "history", end="19980614", depth=C.HISTORY_WEEKS)
    return social.telecom_indicators(_records(spark, sf), S.cohort(spark, sf), "DATA", periods)


def overlapping_edges(spark, sf):
    """Wallet edges over 26 ranges of four weeks, a week apart."""
    weeks = C.weeks_back(F.lit("1998-06-14").cast("date"), 26)
    ranges = F.transform(
        weeks,
        lambda w: F.struct(
            F.date_sub(w[C.PERIOD[0]], 21).alias(C.PERIOD[0]), w[C.PERIOD[1]].alias(C.PERIOD[1])
        ),
    )
    return social.wallet_edges(_graph_tx(spark, sf), periods=C.calendar(spark, ranges))[0]


def late_day_profile(spark, sf):
    """Weekly profiles from day states, one of which was written late: the day's orders
    with an odd key come in a second delivery, which recomputes that day alone."""
    first, late, last = "19980105", "19980211", "19980405"
    orders = S.read(spark, sf, "orders")
    keys, metrics = ["o_orderpriority"], ["o_totalprice"]
    path = _folder(spark, "states")
    missing = P.in_days(F.col("o_orderdate"), late, late) & (F.col("o_orderkey") % 2 == 1)
    early = T.day_states(orders.where(~missing), "o_orderdate", keys, metrics, (first, last))
    T.write_states(early, path)
    T.write_states(T.day_states(orders, "o_orderdate", keys, metrics, (late, late)), path)
    weeks = C.plan_periods(spark, "history", end=last, depth=13)
    return T.profile_of_states(T.read_states(spark, path), keys, metrics, weeks)


def wallet_arpu_range(spark, sf):
    """As ``wallet_arpu``, over days that cut most rows."""
    return wallet.wallet_arpu(S.wallet_tx(spark, sf), S.cohort(spark, sf), ("19970301", "19970831"))


def activity_full_width(spark, sf):
    return usage.activity_extract(S.activity(spark, sf), S.cohort(spark, sf), ("20240101", "20240110"))


def activity_by_user(spark, sf):
    """The activity table that is keyed by ``user_id`` and has no group."""
    rows = S.activity(spark, sf).drop("group_id").withColumnRenamed("mmid", "user_id")
    return usage.activity_extract(
        rows, S.cohort(spark, sf), ("20240103", "20240108"), "user_id", usage.COLUMNS_WITHOUT_GROUP
    )


# -- functions and filters --------------------------------------------------
def msisdn_normalise_all(spark, sf):
    key = S.digits("c_custkey")
    forms = F.array(
        key,
        F.concat(F.lit("7"), key),
        F.concat(F.lit("07"), key),
        F.concat(F.lit("225"), key),
        F.concat(F.lit("22505"), key),
        F.concat(F.lit("0033"), S.digits("c_custkey", 9)),
        F.concat(key, F.lit("x")),
        S.local_number(),
        F.substring(key, 5, 4),
        F.lit(None).cast("string"),
    )
    number = F.col("number")
    return (
        S.read(spark, sf, "customer")
        .select("c_custkey", F.explode(forms).alias("number"))
        .select(
            "c_custkey",
            "number",
            N.canonical(number).alias("canonical"),
            N.by_operator_class(number).alias("by_class"),
            N.by_operator_class(number, strict=True).alias("by_class_strict"),
            N.by_length(number).alias("by_length"),
            N.with_country_code(number).alias("with_country"),
            N.canonical_if_local(number).alias("if_local"),
            N.mark_foreign(number).alias("foreign_marked"),
        )
    )


def label_functions(spark, sf):
    size, price = F.col("p_size"), F.col("p_retailprice")
    benefit = F.concat_ws(" ", "p_name", F.when(size % 4 == 0, "5MB"), F.when(size % 6 == 0, "day"))
    flags = L.benefit_flags(benefit)
    return S.read(spark, sf, "part").select(
        "p_partkey",
        L.subscriber_label((size % 6).cast("string")).alias("subscriber"),
        L.service_label(size % 13).alias("service"),
        L.universe_label(size % 6).alias("universe"),
        L.value_band((price - 900) * 40).alias("band"),
        L.ratio_band(price - 900, size % 10 * F.lit(100.0)).alias("ratio"),
        L.tariff_family(S.profile_name("p_partkey"), F.col("p_type")).alias("tariff"),
        L.terminal_generation(
            F.when(size % 7 < 6, size % 7), F.col("p_retailprice") - 1000
        ).alias("terminal"),
        L.kb_to_mb(price).alias("mb"),
        L.positive_flag(price - 1000).alias("positive"),
        *[flag.cast("int").alias(f"benefit_{name}") for name, flag in flags.items()],
    )


def day_range_filter(spark, sf):
    orders = S.read(spark, sf, "orders")
    wanted = orders.where(P.in_days(F.col("o_orderdate"), "19960105", "19970228"))
    return count_and_sum(wanted, ["o_orderstatus"], "o_totalprice", "n_orders", "total")


def transaction_filters(spark, sf):
    """One count per filter over all transactions."""
    tx = S.wallet_tx(spark, sf)
    status = F.col("transaction_status")
    checks = {
        "n_completed": P.completed(status, F.col("rollbacked")),
        "n_not_cancelled": P.not_cancelled(
            F.when(F.col("transaction_tag") != "A", F.length("sender_user_id")), (3, 4)
        ),
        "n_non_zero": P.non_zero(F.col("service_charge_amount")),
        "n_subscribers": P.both_in(
            F.col("sender_category_code"), F.col("receiver_category_code"), "SUBS"
        ),
        "n_key_range": P.in_keys(F.date_format("transaction_date_time", "yyyyMM"), "199603", "199809"),
        "n_not_like": P.not_like_any(F.col("receiver_category_code"), ["%SH_P%", "%CAPAY"]),
        "n_paid": F.col("commission_oca") > 0,
    }
    return tx.groupBy("transaction_tag").agg(
        *[F.count_if(condition).alias(name) for name, condition in checks.items()]
    )


def open_records(spark, sf):
    rows = S.partners(spark, sf).where(P.open_record(F.col("end_date")))
    return event_count(rows, ["partenaires", "vas_id", "offer_name"], "n_open")


def _records(spark, sf):
    return social.telecom_records(
        S.cdr(spark, sf), S.extensions(spark, sf), S.rated_events(spark, sf)
    )


def category_service_filter(spark, sf):
    rows = social.by_category(_records(spark, sf))
    return rows.groupBy("category", "service", "universe").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum("duration").alias("duration"),
        F.sum("conso_mb").alias("conso"),
    )


def optional_filters(spark, sf):
    records = _records(spark, sf)
    wanted = P.all_of(
        P.in_category(F.col("categorie"), "inter"),
        P.equals_if(F.col("re_id"), "AO"),
        P.equals_if(F.col("universe"), "MOBILE"),
        P.equals_if(F.col("service"), None),
    )
    return event_count(records.where(wanted), ["service", "categorie", "re_id"], "n_records")


# -- joins ------------------------------------------------------------------
def dim_left_join(spark, sf):
    rows = lookup_label(
        S.channel_tx(spark, sf),
        S.code_list(spark, sf),
        "dwh_zb_channel_type_lv",
        recharge.CHANNEL_LIST,
        "type_transaction",
    )
    return count_and_sum(rows, ["type_transaction"], "transfer_amount", "n_rows", "total")


def dim_inner_chain(spark, sf):
    return event_count(_records(spark, sf), ["re_id", "categorie", "service"], "n_records")


def cohort_semi(spark, sf):
    tx = S.wallet_tx(spark, sf).withColumn("msisdn", N.canonical(F.col("sender_msisdn")))
    kept = restrict_to_cohort(tx, S.cohort(spark, sf))
    return count_and_sum(kept, ["msisdn"], "transaction_amount", "n_sent", "total_sent")


def cohort_sifted(spark, sf):
    """As ``cohort_semi``, with a Bloom filter of the cohort in front of the join."""
    tx = S.wallet_tx(spark, sf).withColumn("msisdn", N.canonical(F.col("sender_msisdn")))
    kept = restrict_to_cohort(tx, S.cohort(spark, sf), sieve_words=SIEVE_WORDS)
    return count_and_sum(kept, ["msisdn"], "transaction_amount", "n_sent", "total_sent")


def cohort_outer_complete(spark, sf):
    return complete_with_cohort(cohort_semi(spark, sf), S.cohort(spark, sf))


# -- reshaping --------------------------------------------------------------
def two_sided_rows(spark, sf):
    parties = wallet.wallet_parties(S.wallet_tx(spark, sf), [])
    keys = ["is_send", "tag", "category_code", "other_category_code"]
    return parties.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("pre_balance").alias("pre_balance"),
        F.sum("service_charge").alias("service_charge"),
        F.min("msisdn").alias("first_msisdn"),
    )


def contact_rows(spark, sf):
    numbers = [N.by_operator_class(F.col(c)) for c in ("contact", "second_contact")]
    rows = R.explode_contacts(S.fixed_lines(spark, sf), numbers)
    return event_count(rows, ["nd", "msisdn"], "n_contacts")


# -- graph ------------------------------------------------------------------
def _edges(spark, sf, tagged=True):
    amount = F.col("amount")
    return G.aggregate_edges(
        S.edges(spark, sf),
        F.col("src"),
        F.col("dst"),
        {
            "nbr_transactions": F.count(amount),
            "total_transaction": F.sum(amount),
            "total_charge": F.sum("charge"),
        },
        ["tag"] if tagged else [],
    )


def edge_aggregate(spark, sf):
    return _edges(spark, sf)


def vertex_list(spark, sf):
    return G.vertices_of(S.edges(spark, sf))


def graph_in_out_profile(spark, sf):
    return G.in_out_profile(_edges(spark, sf), "total_transaction")


def graph_degrees(spark, sf):
    return G.degrees(_edges(spark, sf))


def graph_triangles(spark, sf):
    rows = S.edges(spark, sf)
    return with_triangles(G.vertices_of(rows), rows)


def graph_triangles_salted(spark, sf):
    """As ``graph_triangles``, on a grid of many small cells."""
    rows = S.edges(spark, sf)
    return with_triangles(G.vertices_of(rows), rows, edges_per_cell=2_000)


def graph_indicators(spark, sf):
    return social.wallet_graph_indicators(_graph_tx(spark, sf), S.cohort(spark, sf), ALL_DAYS)


def _graph_tx(spark, sf):
    """Wallet transfers between customers: the receiver is named by the part."""
    return S.order_lines(spark, sf).select(
        S.short_number("o_custkey").alias("sender_msisdn"),
        S.short_number("l_partkey").alias("receiver_msisdn"),
        F.lit("TS").alias("transaction_status"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") == 0), "Y").alias("rollbacked"),
        F.lit("SUBS").alias("sender_category_code"),
        F.when(F.col("l_linenumber") == 7, "SHOP").otherwise("SUBS").alias("receiver_category_code"),
        F.col("l_extendedprice").alias("transaction_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("service_charge_amount"),
        F.col("l_returnflag").alias("transaction_tag"),
        F.col("o_orderdate").alias("transaction_date_time"),
    )


def _telecom(service):
    def query(spark, sf):
        records, cohort = _records(spark, sf), S.cohort(spark, sf)
        return social.telecom_indicators(records, cohort, service, ALL_DAYS)

    return query


def peer_in_out_profile(spark, sf):
    return social.message_profile(
        S.cdr(spark, sf),
        S.extensions(spark, sf),
        S.rated_events(spark, sf),
        S.cohort(spark, sf),
        ALL_DAYS,
        service_code=2,
    )


# -- periods ----------------------------------------------------------------
def _per_period(spark, sf, periods: Column):
    rows = S.read(spark, sf, "orders").select("o_totalprice", F.inline(periods))
    return count_and_sum(rows, list(C.PERIOD), "o_totalprice", "n_orders", "total")


def weeks_calendar(spark, sf):
    day = F.to_date("o_orderdate")
    return _per_period(
        spark, sf, F.concat(C.weeks_back(day, 3), C.weeks_between(day, F.date_add(day, 20)))
    )


def forward_weeks_calendar(spark, sf):
    return _per_period(spark, sf, C.weeks_forward(F.to_date("o_orderdate"), 2))


def previous_week(spark, sf):
    return _per_period(spark, sf, F.array(C.previous_week(F.col("o_orderdate"))))


def months_calendar(spark, sf):
    day = F.to_date("o_orderdate")
    ids = F.concat(C.months_between(day, F.date_add(day, 45)), C.months_back(day, 2))
    rows = S.read(spark, sf, "orders").select("o_totalprice", F.explode(ids).alias("month_id"))
    return count_and_sum(rows, ["month_id"], "o_totalprice", "n_orders", "total")


def month_ranges(spark, sf):
    return _per_period(spark, sf, C.month_ranges_back(F.to_date("o_orderdate"), 3))


def days_calendar(spark, sf):
    day = F.to_date("o_orderdate")
    days = F.concat(
        C.days_back(day, 2), F.array(C.snapshot_day(day), C.next_weekday(day, "WED"))
    )
    rows = S.read(spark, sf, "orders").select("o_totalprice", F.explode(days).alias("day"))
    return count_and_sum(rows, ["day"], "o_totalprice", "n_orders", "total")


def backfill_weekly(spark, sf):
    periods = C.plan_periods(spark, "history", end=LAST_SUNDAY, depth=ALL_WEEKS)
    orders, by = C.slice_periods(S.read(spark, sf, "orders"), "o_orderdate", periods)
    return profile(orders, [*by, "o_orderpriority"], ["o_totalprice"], {"n_orders": "o_totalprice"})


# -- segmentation -----------------------------------------------------------
def usage_measures(spark, sf):
    measured = segments.usage_measures(usage_features(spark, sf))
    return measured.select(
        "msisdn",
        *["mnt_transactions", "mnt_transactions_my", "mnt_transactions_max"],
        *["mnt_transactions_min", "service_cash", "service_irt", "service_p2p"],
        *["service_voc", "service_abon", "service_frais", "service_top_up", "service"],
    )


def segment_centroid(spark, sf):
    scored = segments.wallet_segments(
        usage_features(spark, sf),
        S.cohort(spark, sf),
        centroids(MODEL_FEATURES),
        ("202402", "202406"),
    )
    return scored.select(
        "msisdn", "periode", "arpu_om", "mnt_transactions", "service", "label", "categorie", "cluster"
    )


def segment_kmeans(spark, sf):
    """Trained centres: rows, rows whose label is not the nearest centre by a second
    computation, and rows without category."""
    features = usage_features(spark, sf)
    trained = M.fit_centroids(features, MODEL_FEATURES, k=7, seed=7)
    named = {label: f"S{label + 1}1" for label in trained}
    scored = segments.wallet_segments(
        features, S.cohort(spark, sf), trained, splits={}, whole=named
    )

    def far(label: int) -> Column:
        return sum((F.col(f) - x) ** 2 for f, x in zip(MODEL_FEATURES, trained[label], strict=True))

    own = F.coalesce(*[F.when(F.col("label") == label, far(label)) for label in trained])
    least = F.least(*[far(label) for label in trained])
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(own > least * (1 + 1e-9)).alias("n_not_nearest"),
        F.count_if(F.col("categorie").isNull()).alias("n_unnamed"),
    )


def registered() -> dict[str, Query]:
    plain = [
        wallet_profile, wallet_arpu, profile_large_groups, transfer_profile,
        transfer_profile_per_direction, recharge_weekly_profile, recharge_tag_profile,
        recharge_strict_tag_profile, subscription_mix, activity_extract, data_usage_profile, bill_payments,
        file_partitioned_csv, file_published, file_plain_csv, file_cohort, wallet_arpu_range, activity_full_width, backfill_locations, backfill_value_segments,
        backfill_wallet_arpu, history_telecom_sms, history_telecom_data, overlapping_edges,
        late_day_profile, activity_by_user, cohort_sifted, line_base_tdd, line_base_ftth,
        value_segments, multi_flag, fleet_flag, geo_location, line_base_one_contact,
        line_base_two_contacts, msisdn_normalise_all, label_functions, day_range_filter,
        transaction_filters, open_records, category_service_filter, optional_filters,
        dim_left_join, dim_inner_chain, cohort_semi, cohort_outer_complete, two_sided_rows,
        contact_rows, edge_aggregate, vertex_list, graph_in_out_profile, graph_degrees,
        graph_triangles, graph_triangles_salted, graph_indicators, peer_in_out_profile,
        weeks_calendar, forward_weeks_calendar, previous_week, months_calendar, month_ranges,
        days_calendar, backfill_weekly, usage_measures, segment_centroid, segment_kmeans,
    ]
    named = {query.__name__: query for query in plain}
    for service in ("SMS", "VOIX", "DATA", "SVA", "IMS", "UNKNOWN"):
        named[f"telecom_{service.lower()}"] = _telecom(service)

    def rounded(query: Query) -> Query:
        return lambda spark, sf_dir: stable(query(spark, sf_dir))

    return {name: rounded(query) for name, query in named.items()}
