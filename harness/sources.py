"""Source frames with the layouts the jobs expect, derived from the test tables.

Each has a twin in :mod:`harness.source_sql`, written separately in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.plans.usage import ACTIVITY_COLUMNS

PROFILES = (
    "xCommunityx", "SPXD_BR_NOVA", "SP_D_OI_1", "mytest", "dauphin", "KIT_JEUNE",
    "bara", "neo plus second", "orangina", "other", "abc2007", "sp br_nova x",
)
MONTHS = ("202401", "202402")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def digits(key: str, size: int = 8) -> Column:
    return F.lpad(F.col(key).cast("string"), size, "0")


def home_number(key: str) -> Column:
    return F.concat(F.lit("22507"), digits(key))


def short_number(key: str) -> Column:
    return F.concat(F.lit("07"), digits(key))


def snapshot_day(key: str) -> Column:
    """One of the first three days of 2024."""
    return F.concat(F.lit("2024010"), (F.col(key) % 3 + 1).cast("string"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of the delivered activity file, each another number."""
    numbers = [
        ((F.col("event_id") * (i + 3)) % 1009).alias(name)
        for i, name in enumerate(ACTIVITY_COLUMNS)
        if name != "datedata"
    ]
    return read(spark, sf_dir, "events").select(
        short_number("user_id").alias("mmid"), F.col("ts").alias("datedata"), *numbers
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with money on their account."""
    customers = read(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return customers.select(home_number("c_custkey").alias("phone"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order. Both tables are large at scale; the hint keeps the
    small test runs on the plan that a large run gets."""
    lines, orders = read(spark, sf_dir, "lineitem").hint("MERGE"), read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def wallet_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, paid = F.col("l_extendedprice"), F.col("l_quantity") * 100
    tenth = F.col("l_suppkey") % 10 == 0
    return order_lines(spark, sf_dir).select(
        short_number("o_custkey").alias("sender_msisdn"),
        F.concat(F.lit("22505"), digits("l_suppkey")).alias("receiver_msisdn"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sender_user_id"),
        F.concat(F.lit("R"), F.col("l_suppkey").cast("string")).alias("receiver_user_id"),
        F.when(F.col("o_orderstatus").isin("F", "P"), "TS").otherwise("TF").alias(
            "transaction_status"
        ),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_discount") == 0), "Y").alias(
            "rollbacked"
        ),
        F.lit("SUBS").alias("sender_category_code"),
        F.when(F.col("l_linestatus") == "O", "SUBS").otherwise(
            F.when(tenth, "PDVCAPAY").otherwise("SHOP")
        ).alias("receiver_category_code"),
        F.when(tenth, "CAPAY").otherwise("OTHER").alias("receiver_domain_code"),
        F.col("o_totalprice").alias("sender_pre_balance"),
        (F.col("o_totalprice") - price).alias("sender_post_balance"),
        paid.alias("receiver_pre_balance"),
        (paid + price).alias("receiver_post_balance"),
        price.alias("transaction_amount"),
        (price * F.col("l_tax")).alias("service_charge_amount"),
        F.col("l_tax").alias("commission_oca"),
        F.col("l_returnflag").alias("transaction_tag"),
        F.col("o_orderdate").alias("transaction_date_time"),
    )


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("s_nationkey")
    return read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("22505"), digits("s_suppkey")).alias("msisdn"),
        F.concat(F.lit("BILL"), nation.cast("string")).alias("partenaires"),
        F.when(F.col("s_acctbal") < 0, "OTHER").otherwise("FACTURES").alias("vas_id"),
        F.when(nation % 5 == 0, "Financier").otherwise("Standard").alias("offer_name"),
        F.when(nation % 7 == 3, F.lit("2020-01-01"))
        .otherwise(F.lit("9999-12-31"))
        .cast("date")
        .alias("end_date"),
    )


def credit_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(
        short_number("o_custkey").alias("sender_msisdn"),
        F.concat(F.lit("22505"), digits("l_suppkey")).alias("receiver_msisdn"),
        F.col("l_extendedprice").alias("transfer_value"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias(
            "final_transfer_status_lv"
        ),
        F.col("o_orderdate").alias("transfer_date_time"),
    )


def channel_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    base = (
        F.when(kind == "click", 2250700000000)
        .when(kind == "view", 1000000000)
        .otherwise(700000000)
    )
    return read(spark, sf_dir, "events").select(
        F.col("ts").alias("transfer_date_time"),
        (base + user).alias("receiver_msisdn"),
        kind.alias("dwh_zb_channel_type_lv"),
        (F.col("value") * 100).alias("transfer_amount"),
        (F.col("value") * 10).alias("commision"),
        F.when(kind == "signup", "5").otherwise("200").alias("dwh_transfer_status_lv"),
    )


def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = read(spark, sf_dir, "events").select("event_type").distinct()
    lists = F.array(F.lit("DWH_ZB_CHANNEL_TYPE_LV"), F.lit("ANOTHER_LIST"))
    return kinds.where(F.col("event_type") != "error").select(
        F.col("event_type").alias("lv_code"),
        F.explode(lists).alias("lv_name"),
        F.upper("event_type").alias("lv_label"),
    )


def recharges(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return read(spark, sf_dir, "events").select(
        short_number("user_id").alias("acc_nbr"),
        value.alias("bill_amount"),
        (value * 2).alias("initial_loan_amount"),
        (value / 2).alias("amount_already_pay_back"),
        F.when(value <= 20, value * 3).alias("amount_remain_to_pay_back"),
        F.when(k % 3 == 0, 5).when(k % 3 == 1, 30).otherwise(7).alias("contact_channel_id"),
        F.when(kind == "error", "EMERGENCY CREDIT")
        .when(kind == "view", "emergency data")
        .when(kind != "signup", kind)
        .alias("benefit_name"),
        F.when(F.col("user_id") % 6 < 5, (F.col("user_id") % 6).cast("string")).alias(
            "subscriber_type_lv"
        ),
        F.col("ts").alias("pay_time"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    return read(spark, sf_dir, "orders").select(
        short_number("o_custkey").alias("acc_nbr"),
        F.when(priority == "1", "data plus")
        .when(priority == "2", F.concat((F.col("o_orderkey") % 10).cast("string"), F.lit("Gb")))
        .when(priority == "3", "one Week")
        .when(priority == "4", "gift")
        .alias("benefit_name"),
        F.when(F.col("o_orderstatus") == "F", 1)
        .when(F.col("o_orderstatus") == "O", 2)
        .alias("subscriber_type_lv"),
        F.col("o_orderdate").alias("created_date"),
    )


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, size = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    services = F.array(*[F.lit(s) for s in (1, 2, 4, 10, 512, 3, 2)])
    return order_lines(spark, sf_dir).select(
        short_number("o_custkey").alias("calling_nbr"),
        F.when(line == 7, F.concat(F.lit("0033"), digits("l_partkey", 9)))
        .otherwise(home_number("l_partkey"))
        .alias("called_nbr"),
        short_number("o_custkey").alias("billing_nbr"),
        F.concat("l_returnflag", "l_linestatus").alias("re_id"),
        size.alias("duration"),
        (F.round(F.col("l_discount") * 100).cast("bigint") * size).alias("bytes_0"),
        F.element_at(services, line).alias("service_type_lv"),
        F.when(F.col("l_tax") == 0, 1).otherwise(2).alias("dim_universe_lv"),
        F.col("l_suppkey").cast("int").alias("called_prefix_id"),
        (line % 2).alias("acct_res_id1"),
        (line % 3).alias("acct_res_id2"),
        F.lit(1).alias("acct_res_id3"),
        F.lit(0).alias("acct_res_id4"),
        F.col("l_extendedprice").alias("charge1"),
        (F.col("l_tax") * 100).alias("charge2"),
        F.col("l_quantity").alias("charge3"),
        F.lit(5.0).alias("charge4"),
        F.col("l_shipdate").alias("start_time"),
    )


def extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = read(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0)
    return known.select(F.col("s_suppkey").cast("int").alias("dwh_extension_id"))


def rated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    kinds = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    return kinds.where((flag != "N") | (F.col("l_linestatus") != "F")).select(
        F.concat("l_returnflag", "l_linestatus").alias("re_id"),
        F.when(flag == "A", "CALL INTER")
        .when(flag == "R", "ROAMING IN")
        .otherwise("NATIONAL")
        .alias("re_category_lv"),
    )


def _month_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = F.array(*[F.lit(m) for m in MONTHS])
    key = F.col("c_custkey")
    number = (
        F.when(key % 4 == 0, F.concat(F.lit("225"), digits("c_custkey")))
        .when(key % 4 == 1, digits("c_custkey"))
        .otherwise(home_number("c_custkey"))
    )
    return (
        read(spark, sf_dir, "customer")
        .withColumn("month_id", F.explode(months))
        .withColumn("msisdn", number)
    )


def profile_name(key: str) -> Column:
    names = F.array(*[F.lit(p) for p in PROFILES])
    return F.element_at(names, (F.col(key) % len(PROFILES) + 1).cast("int"))


def client_type() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", "hybride")
        .when(segment == "MACHINERY", "Postpaid")
        .otherwise("PREPAID")
    )


def value_datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, money = F.col("c_nationkey"), F.greatest(F.col("c_acctbal"), F.lit(0.0))
    return _month_rows(spark, sf_dir).select(
        "msisdn",
        "month_id",
        profile_name("c_custkey").alias("profil_endperiod"),
        client_type().alias("type_client_endperiod"),
        (money * 4).alias("conso_cp_tot"),
        F.when(nation == 3, money * -4).otherwise(nation * 500.0).alias("conso_forfait_tot"),
        (money * 10).alias("vol_tot_data_ko"),
        nation.alias("nb_tot_pass_data"),
        money.alias("conso_cp_tot_pass_data"),
        (money + 1).alias("conso_forfait_tot_pass_data"),
        (nation + 1).alias("nb_tot_pass_ix"),
        (money / 2).alias("conso_cp_tot_pass_ix"),
        (money / 4).alias("conso_forfait_tot_pass_ix"),
        F.when(nation == 5, 0.0).otherwise(money).alias("om_rc_amount"),
        F.when(nation == 5, 0.0).otherwise(nation * 400.0).alias("rc_montant_tot"),
        (money / 4).alias("conso_cp_tot_pass_via_om"),
        (nation * 10.0).alias("conso_forf_tot_pass_via_om"),
    )


def terminal_datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_custkey") % 7
    return _month_rows(spark, sf_dir).select(
        "msisdn",
        "month_id",
        F.when(kind < 6, kind.cast("int")).alias("type_terminal"),
        F.when(F.col("c_acctbal") > 8000, F.col("c_acctbal")).otherwise(0.0).alias("vol_4g_ota_mo"),
    )


def local_number() -> Column:
    """Eight digits whose second one depends on the nation."""
    return F.concat(
        F.lit("0"),
        (F.col("c_nationkey") % 10).cast("string"),
        F.lpad((F.col("c_custkey") % 1000000).cast("string"), 6, "0"),
    )


def line_number() -> Column:
    second = F.col("c_nationkey") % 10
    prefix = F.when(second <= 3, "22501").when(second <= 6, "22505").otherwise("22507")
    return F.concat(prefix, local_number())


def line_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return customers.select(line_number().alias("phone"))


def written_number() -> Column:
    """The same number as people write it: with or without country code."""
    way = F.col("c_custkey") % 5
    return (
        F.when(way == 0, local_number())
        .when(way == 1, F.concat(F.lit("225"), local_number()))
        .when(way == 2, line_number())
        .when(way == 3, F.concat(local_number(), F.lit("x")))
    )


def sim_registry_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return read(spark, sf_dir, "customer").select(
        written_number().alias("msisdn"),
        F.when(nation % 2 == 0, 1).alias("statut_home"),
        (nation % 3 == 0).cast("int").alias("statut_alpha"),
        (nation % 5 == 0).cast("int").alias("statut_beta"),
    )


def sim_registry_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("225"), local_number()).alias("msisdn"),
        F.when(F.col("o_totalprice") > 400000, 1).alias("top_ds_on"),
        F.when((status == "P") & (F.col("o_totalprice") > 300000), "ALPHA")
        .when((status == "O") & (F.col("o_totalprice") > 200000), "BETA")
        .alias("op_offnet"),
    )


def fleet_datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    segment = F.col("c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        short_number("c_custkey").alias("msisdn"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("date_id"),
        F.when(segment == "BUILDING", "HYBRIDE")
        .when(segment == "MACHINERY", "POSTPAID")
        .when(segment == "FURNITURE", "HYBRID")
        .when(segment == "HOUSEHOLD", "PREPAID")
        .alias("type_client_endperiod"),
        profile_name("c_custkey").alias("profil_endperiod"),
        (F.col("o_totalprice") - 100000).alias("vol_tot_voix_intra_fl"),
    )


def location_datamart(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer")
    nations, regions = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    placed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.select(
        short_number("c_custkey").alias("msisdn"),
        F.col("r_name").alias("zone_commerciale"),
        F.col("n_name").alias("nom_region"),
        F.lower("n_name").alias("nom_depart"),
        F.col("c_mktsegment").alias("unite_administrative"),
        F.lower("c_mktsegment").alias("geolocalite"),
        F.col("c_name").alias("quartier"),
        snapshot_day("c_custkey").alias("date_id"),
    )


def fixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    other = (
        F.when(nation % 3 == 0, line_number())
        .when(nation % 3 == 1, F.concat(F.lit("225"), local_number()))
        .otherwise("n/a")
    )
    return read(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("plan_tarifaire"),
        F.concat(nation.cast("string"), F.lit("M")).alias("debit"),
        F.lower("c_mktsegment").alias("categorie"),
        F.lower("c_mktsegment").alias("categorie_offre"),
        F.when(nation < 12, "HOME").otherwise("OFFICE").alias("categorie_client"),
        F.when(F.col("c_acctbal") > 5000, "ACTIVE").otherwise("IDLE").alias("etat"),
        written_number().alias("contact"),
        other.alias("second_contact"),
        F.concat(F.lit("CITY"), nation.cast("string")).alias("ville"),
        F.col("c_name").alias("nd"),
        snapshot_day("c_custkey").alias("date_jour"),
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who bought which part, on one shared range of ids."""
    return order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("src"),
        F.col("l_partkey").alias("dst"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("charge"),
        F.col("l_returnflag").alias("tag"),
    )
