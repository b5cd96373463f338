import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridgeway.operators.calendar import calendar, weeks_back
from ridgeway.plans import lines, recharge, segments, social, subscribers, usage, wallet

DAY = dt.datetime(2024, 1, 3, 12)
NEXT_WEEK = dt.datetime(2024, 1, 10, 12)
DAYS = ("20240101", "20240131")


def phone(n):
    return f"22507{n:08d}"


@pytest.fixture(scope="module")
def cohort(spark):
    return spark.createDataFrame([(phone(1),), (phone(2),), (phone(2),), (phone(9),)], "phone string")


@pytest.fixture(scope="module")
def weeks(spark):
    return calendar(spark, weeks_back(F.lit(dt.date(2024, 1, 14)), 2))


WALLET = (
    "sender_msisdn string, receiver_msisdn string, transaction_status string, rollbacked string,"
    "transaction_amount double, service_charge_amount double, transaction_tag string,"
    "transaction_date_time timestamp_ntz, receiver_category_code string,"
    "receiver_domain_code string, commission_oca double"
)


def wallet_tx(spark, data):
    frame = spark.createDataFrame(data, WALLET)
    return frame.withColumns(
        {
            "sender_user_id": F.concat(F.lit("u"), F.col("sender_msisdn")),
            "receiver_user_id": F.concat(F.lit("u"), F.col("receiver_msisdn")),
            "sender_category_code": F.lit("SUBS"),
            "sender_pre_balance": F.lit(100.0),
            "sender_post_balance": F.lit(90.0),
            "receiver_pre_balance": F.lit(5.0),
            "receiver_post_balance": F.lit(15.0),
        }
    )


def tx(sender, receiver, amount, charge=1.0, status="TS", back=None, tag="P2P", when=DAY,
       category="SUBS", domain="X", commission=0.0):
    return (
        sender if isinstance(sender, str) else phone(sender),
        receiver if isinstance(receiver, str) else phone(receiver),
        status, back, amount, charge, tag, when, category, domain, commission,
    )


def test_wallet_profile_describes_both_parties_of_good_transactions(spark, cohort):
    data = [
        tx(1, 2, 10.0), tx(1, 2, 30.0), tx(1, 3, 7.0, status="TF"), tx(1, 3, 7.0, back="Y"),
        tx(1, 2, 99.0, when=dt.datetime(2023, 12, 31, 23, 59)), tx(3, 4, 5.0),
    ]
    got = {
        (r["msisdn"], r["is_send"]): r
        for r in wallet.wallet_profile(wallet_tx(spark, data), cohort, DAYS).collect()
    }
    assert set(got) == {(phone(1), 1), (phone(2), 0)}
    sender, receiver = got[phone(1), 1], got[phone(2), 0]
    assert sender["n_transactions"] == 2 and sender["amount_p50"] == 20.0
    assert sender["pre_balance_p0"] == 100.0 and receiver["pre_balance_p0"] == 5.0
    assert sender["user_id"] == "u" + phone(1) and receiver["user_id"] == "u" + phone(2)
    assert len(got[phone(1), 1]) == 6 + 1 + 4 * 7


def test_one_job_over_many_periods_equals_one_job_each(spark, cohort, weeks, rows):
    data = [tx(1, 2, float(i), when=dt.datetime(2024, 1, 1) + dt.timedelta(hours=9 * i)) for i in range(40)]
    frame = wallet_tx(spark, data)
    together = wallet.wallet_arpu(frame, cohort, weeks)
    apart = []
    for start, end in (tuple(w) for w in weeks.collect()):
        alone = wallet.wallet_arpu(frame, cohort, (start, end))
        apart += [(start, end, *r) for r in alone.collect()]
    assert rows(together) == sorted(apart, key=repr)
    assert len(apart) == 4


def test_transfer_profile_counts_zero_rows_unless_told_otherwise(spark, cohort):
    data = [
        (phone(1), phone(2), 10.0, 1, DAY), (phone(2), phone(1), 4.0, 1, DAY),
        (phone(1), phone(2), 99.0, 5, DAY), (phone(1), phone(2), 99.0, None, DAY),
    ]
    frame = spark.createDataFrame(
        data,
        "sender_msisdn string, receiver_msisdn string, transfer_value double,"
        "final_transfer_status_lv int, transfer_date_time timestamp_ntz",
    )
    mixed = {r["msisdn"]: r for r in wallet.transfer_profile(frame, cohort, DAYS).collect()}[phone(1)]
    assert (mixed["n_transfer_in"], mixed["transfer_in_avg"], mixed["transfer_out_p100"]) == (2, 2.0, 10.0)
    split = {
        r["msisdn"]: r
        for r in wallet.transfer_profile(frame, cohort, DAYS, per_direction=True).collect()
    }[phone(1)]
    assert (split["n_transfer_in"], split["n_transfer_out"], split["transfer_in_avg"]) == (1, 1, 4.0)


def test_bill_payments(spark, cohort, rows):
    data = [
        tx(1, "B1", 10.0, category="M", domain="D"), tx(1, "B1", 5.0, category="M", domain="D"),
        tx(1, "B1", 3.0, category="PDVCAPAY", domain="CAPAY", commission=1.0),
        tx(1, "B1", 4.0, category="PDVCAPAY", domain="CAPAY"), tx(2, "B2", 8.0, category="M", domain="D"),
        tx(2, "B3", 8.0, category="M", domain="D"), tx(1, "B1", 9.0, status="TF", category="M", domain="D"),
        tx(2, "B4", 6.0, category="M", domain="D"), tx(1, "B1", 2.0, category=None, domain="D"),
        tx(1, "B1", 1.0, category="M", domain="D", when=dt.datetime(2024, 1, 31, 23, 0)),
    ]
    open_end, past = dt.date(9999, 12, 31), dt.date(2020, 1, 1)
    partners = spark.createDataFrame(
        [
            ("B1", "POWER", "FACTURES", "Std", open_end), ("B2", "SAFE", "FACTURES", "Financier", open_end),
            ("B3", "OLD", "FACTURES", "Std", past), ("B4", "WATER", "FACTURES", "Std", open_end),
            ("B4", "GAS", "FACTURES", "Std", open_end), ("B4", "X", "OTHER", "Std", open_end),
        ],
        "msisdn string, partenaires string, vas_id string, offer_name string, end_date date",
    )
    got = rows(wallet.bill_payments(wallet_tx(spark, data), partners, cohort, DAYS))
    day, last = DAY.date(), dt.date(2024, 1, 31)
    assert got == sorted(
        [
            (day, phone(1), "POWER", 2, 15.0), (day, phone(1), "CANAL+", 1, 3.0),
            (day, phone(2), "PAIEMENT ASSURANCE", 1, 8.0), (day, phone(2), "WATER", 1, 6.0),
            (day, phone(2), "GAS", 1, 6.0), (last, phone(1), "POWER", 1, 1.0),
        ],
        key=repr,
    )


def test_electronic_recharge_profile(spark, cohort):
    data = [
        (DAY, 700000001, "1", 10.0, 1.0, "200"), (DAY, 2250700000001, "1", 20.0, 2.0, "200"),
        (DAY, 700000001, "9", 5.0, 1.0, "200"), (DAY, 700000001, "1", 5.0, 1.0, "5"),
        (dt.datetime(2021, 1, 3), 700000001, "1", 7.0, 1.0, "200"),
    ]
    frame = spark.createDataFrame(
        data,
        "transfer_date_time timestamp_ntz, receiver_msisdn long, dwh_zb_channel_type_lv string,"
        "transfer_amount double, commision double, dwh_transfer_status_lv string",
    )
    codes = spark.createDataFrame(
        [("1", recharge.CHANNEL_LIST, "AGENT"), ("9", "OTHER", "NO")],
        "lv_code string, lv_name string, lv_label string",
    )
    result = recharge.electronic_recharge_profile(frame, codes, cohort, with_year=True)
    got = {(r["year_of_week"], r["week_nb"], r["type_transaction"]): r for r in result.collect()}
    assert set(got) == {(2024, 1, "AGENT"), (2024, 1, None), (2020, 53, "AGENT")}
    assert got[2024, 1, "AGENT"]["n_transfers"] == 2
    assert got[2024, 1, "AGENT"]["transfer_amount_p75"] == 17.5


@pytest.fixture(scope="module")
def recharges(spark):
    data = [
        (phone(1), 10.0, 1.0, None, 3.0, 5, "emergency credit", "1"),
        (phone(1), 20.0, 1.0, 2.0, 3.0, 30, "EMERGENCY DATA", "1"),
        (phone(1), 40.0, None, 2.0, 3.0, 7, "EMERGENCY DATA", "1"),
        (phone(1), 80.0, 1.0, 2.0, 3.0, 5, None, "1"),
    ]
    return spark.createDataFrame(
        data,
        "acc_nbr string, bill_amount double, initial_loan_amount double,"
        "amount_already_pay_back double, amount_remain_to_pay_back double, contact_channel_id int,"
        "benefit_name string, subscriber_type_lv string",
    ).withColumn("pay_time", F.lit(DAY))


def test_recharge_profile_as_delivered(recharges, cohort):
    row = recharge.recharge_profile(recharges, cohort, DAYS).first()
    assert row["subscriber_type"] == "PREPAID"
    assert (row["n_sos_credit"], row["n_sos_data"], row["n_other_recharge"]) == (4, 4, 4)
    assert row["sos_credit_amount_avg"] == 2.5 and row["sos_data_amount_p100"] == 20.0
    assert row["other_recharge_amount_avg"] == 37.5
    assert row["other_recharge_initial_loan_p0"] == 0.0
    assert len(row) == 2 + 3 + 12 * 7


def test_recharge_profile_with_strict_tags(recharges, cohort):
    row = recharge.recharge_profile(recharges, cohort, DAYS, strict_tags=True).first()
    assert (row["n_sos_credit"], row["n_sos_data"], row["n_other_recharge"]) == (1, 1, 2)
    assert row["sos_credit_amount_avg"] == 10.0 and row["other_recharge_amount_avg"] == 60.0


def test_subscription_mix(spark, cohort, rows):
    data = [(phone(1), b, "2", DAY) for b in ("500MB", "data", "1 day", None, "gift")]
    data.append((phone(5), "data", "2", DAY))
    frame = spark.createDataFrame(
        data, "acc_nbr string, benefit_name string, subscriber_type_lv string, created_date timestamp_ntz"
    )
    row = recharge.subscription_mix(frame, cohort, DAYS).collect()
    assert len(row) == 1 and row[0].asDict() == {
        "msisdn": phone(1), "subscriber_type": "POSTPAID", "nbr_souscription_data": 1.0,
        "nbr_souscription_mix": 1.0, "nbr_souscription_appel_sms": 1.0, "nbr_souscription_others": 2.0,
    }


def test_activity_extract_keeps_the_listed_columns(spark, cohort):
    base = spark.createDataFrame([("07" + phone(1)[-8:], dt.date(2024, 1, 31)), ("x", dt.date(2024, 1, 31))],
                                 "mmid string, datedata date")
    full = base.withColumns({c: F.lit(1) for c in usage.ACTIVITY_COLUMNS[1:]}).withColumn("extra", F.lit(0))
    result = usage.activity_extract(full, cohort, DAYS)
    assert result.columns == ["mmid", *usage.ACTIVITY_COLUMNS] and result.count() == 1
    assert len(usage.ACTIVITY_COLUMNS) == 37
    other = full.withColumnRenamed("mmid", "user_id").drop("group_id")
    result = usage.activity_extract(
        other, cohort, DAYS, key="user_id", columns=usage.COLUMNS_WITHOUT_GROUP
    )
    assert result.first()["mmid"] == phone(1)


def test_data_usage_leaves_out_empty_sessions(spark, cohort):
    frame = spark.createDataFrame(
        [(phone(1), 0, DAY), (phone(1), 10, DAY), (phone(1), None, DAY), (phone(7), 5, DAY)],
        "billing_nbr string, bytes_0 long, start_time timestamp_ntz",
    )
    got = usage.data_usage_profile(frame, cohort, DAYS).collect()
    assert len(got) == 1 and (got[0]["n_sessions"], got[0]["bytes_avg"]) == (1, 10.0)


def test_network_flags_merge_both_registries(spark, rows):
    cohort = spark.createDataFrame([("2250505412345",), ("2250709912345",)], "phone string")
    a = spark.createDataFrame(
        [("05412345", None, 1, 0), ("22509912345", 0, 0, None), ("bad", 1, 1, 1)],
        "msisdn string, statut_home int, statut_alpha int, statut_beta int",
    )
    b = spark.createDataFrame(
        [("22505412345", 1, "BETA"), ("22505412345", 0, "ALPHA"), ("0712", 1, "BETA")],
        "msisdn string, top_ds_on int, op_offnet string",
    )
    assert rows(subscribers.network_flags(a, b, cohort, "home", {"alpha": "ALPHA", "beta": "BETA"})) == [
        ("2250505412345", 1, 1, 1),
        ("2250709912345", 0, 0, 0),
    ]


def test_fleet_flag(spark, cohort, rows):
    frame = spark.createDataFrame(
        [
            (phone(1), "20240101", "HYBRID", "x", 5.0), (phone(2), "20240101", "POSTPAID", "x", 0.0),
            (phone(9), "20240101", "POSTPAID", "sp br_nova", 5.0), (phone(9), "20240102", "HYBRID", "x", 5.0),
            (phone(9), "20240101", "PREPAID", "x", 5.0), (phone(9), "20240101", "HYBRID", None, 5.0),
        ],
        "msisdn string, date_id string, type_client_endperiod string, profil_endperiod string,"
        "vol_tot_voix_intra_fl double",
    )
    assert rows(subscribers.fleet_flag(frame, cohort, "20240101")) == [
        (phone(1), 1, "20240101"),
        (phone(2), 0, "20240101"),
    ]


def test_wired_base_matches_either_contact(spark):
    # as written, only the first contact was matched
    frame = spark.createDataFrame(
        [("P", "10M", "c", "home", "ON", "bad", "05412345", "T", "n1", "20240101"),
         ("P", "10M", "c", "home", "ON", "05412345", "22505412345", "T", "n2", "20240101"),
         ("P", "10M", "c", "home", "ON", "05412345", None, "T", "n3", "20240102")],
        "plan_tarifaire string, debit string, categorie string, categorie_client string, etat string,"
        "contact string, second_contact string, ville string, nd string, date_jour string",
    )
    cohort = spark.createDataFrame([("2250505412345",)], "phone string")
    got = lines.wired_base(frame, cohort, "20240101").collect()
    assert sorted(r["numero"] for r in got) == ["n1", "n2"]
    renamed = frame.withColumnsRenamed({"nd": "numero_adsl", "categorie_client": "category_client"})
    again = lines.wired_base(
        renamed, cohort, "20240101", client_category="category_client", number="numero_adsl"
    )
    assert again.columns == lines.wired_base(frame, cohort).columns and again.count() == 2


def test_wallet_graph_per_period_equals_each_period_alone(spark, cohort, weeks, rows):
    ring = [(1, 2), (2, 9), (9, 1)]
    data = [tx(a, b, 5.0) for a, b in ring] + [tx(b, a, 2.0) for a, b in ring]
    data += [tx(1, 2, 1.0, when=NEXT_WEEK), tx(2, 1, 1.0, when=NEXT_WEEK, tag="OTHER")]
    frame = wallet_tx(spark, data)
    together = rows(social.wallet_graph_indicators(frame, cohort, weeks))
    apart = []
    for start, end in (tuple(w) for w in weeks.collect()):
        alone = social.wallet_graph_indicators(frame, cohort, (start, end))
        apart += [(start, end, *r) for r in alone.collect()]
    assert together == sorted(apart, key=repr) and len(together) == 5
    tagged = social.wallet_graph_indicators(frame, cohort, ("20240108", "20240114"), tag="OTHER")
    assert tagged.count() == 0


CDR = (
    "calling_nbr string, called_nbr string, billing_nbr string, re_id string, duration long,"
    "bytes_0 long, service_type_lv int, dim_universe_lv int, called_prefix_id int"
)


@pytest.fixture(scope="module")
def telecom(spark):
    sms, voice, data = 4, 2, 1
    rows = [
        (phone(1), phone(2), phone(1), "A", 10, 0, sms, 2, 1),
        (phone(1), phone(2), phone(1), "A", 10, 0, sms, 2, 1),
        (phone(2), phone(1), phone(2), "B", 10, 0, sms, 2, 1),
        (phone(1), "33612345678", phone(1), "B", 20, 0, voice, 2, 1),
        (phone(2), phone(1), phone(2), "A", 30, 0, voice, 2, 1),
        (phone(1), phone(2), phone(1), "A", 40, 0, voice, 2, 1),
        (phone(1), phone(2), phone(1), "A", 0, 100, data, 2, 1),
        (phone(1), phone(2), phone(1), "A", 0, 300, data, 1, 1),
        (phone(1), phone(2), phone(1), "A", 0, 500, data, 2, 7),
        (phone(1), phone(2), phone(1), "Z", 0, 700, data, 2, 1),
        (phone(2), phone(1), phone(2), "A", 0, 0, 77, 2, 1),
    ]
    cdr = spark.createDataFrame(rows, CDR).withColumns(
        {
            **{f"acct_res_id{i}": F.lit(1 if i < 3 else 2) for i in range(1, 5)},
            **{f"charge{i}": F.lit(50.0 * i) for i in range(1, 5)},
            "start_time": F.lit(DAY),
        }
    )
    extensions = spark.createDataFrame([(1,), (1,)], "dwh_extension_id int")
    events = spark.createDataFrame([("A", "CALL INTER"), ("B", "ROAMING")], "re_id string, re_category_lv string")
    return cdr, extensions, events


def test_telecom_services_and_categories(telecom, cohort):
    records = social.telecom_records(*telecom)
    sms = {(r["category"], r["msisdn"]): r for r in social.telecom_indicators(records, cohort, "SMS", DAYS).collect()}
    assert set(sms) == {("local", phone(1)), ("local", phone(2))}
    assert sms["local", phone(1)]["sum_nbr_exch_sms_out"] == 2
    assert sms["local", phone(1)]["sum_nbr_exch_sms_in"] == 1

    voice = social.telecom_indicators(records, cohort, "VOIX", DAYS).collect()
    first = {(r["category"], r["msisdn"]): r for r in voice}["local", phone(1)]
    assert (first["n_peers_total_duration_voix_out"], first["max_total_duration_voix_out"]) == (2, 40)

    data = social.telecom_indicators(records, cohort, "DATA", DAYS).collect()
    assert {r["category"] for r in data} == {"local", "inter"}
    assert data[0]["n_exch_data"] == 1 and data[0]["bytes_sum"] == 100 and data[0]["conso_mb_sum"] == 1.5

    unknown = social.telecom_indicators(records, cohort, "UNKNOWN", DAYS, categories=["local"]).collect()
    assert [(r["msisdn"], r["nbr_exch_unknown"]) for r in unknown] == [(phone(2), 1)]
    by_event = social.telecom_indicators(records, cohort, "DATA", DAYS, ["inter"], re_id="B")
    assert by_event.count() == 0
    with pytest.raises(ValueError):
        social.telecom_indicators(records, cohort, "FAX")


def test_message_profile_keeps_silent_members(telecom, cohort, weeks):
    result = social.message_profile(*telecom, cohort, DAYS, service_code=4)
    got = {(r["category"], r["msisdn"]): r for r in result.collect()}
    assert len(got) == 9
    assert got["local", phone(1)]["nbr_dst"] == 1 and got["local", phone(1)]["msg_out_sum"] == 2
    assert got["local", phone(1)]["nbr_src"] == 1 and got["local", phone(1)]["msg_in_sum"] == 1
    assert got["local", phone(9)]["nbr_src"] is None
    assert got["roaming", phone(1)]["nbr_dst"] is None and got["roaming", phone(1)]["nbr_src"] == 1
    assert social.message_profile(*telecom, cohort, weeks, service_code=4).count() == 18


def test_wallet_segments_keep_descriptor_nulls_and_fill_the_rest(spark, cohort):
    from ridgeway.functions import usage as U

    names = {*U.AMOUNTS, *U.MODEL_FEATURES, U.BILL_USAGE, U.SCHOOL_USAGE}
    names |= {f"{p}_{s}" for p in ("max", "min") for s in U.PEAK_SERVICES}
    names |= {c for pair in U.SERVICE_USAGE.values() for c in pair}
    base = spark.createDataFrame(
        [(phone(1), "202401", None, 10.0, None), (phone(2), "202402", 3.0, 20.0, "N"), (phone(9), "202403", 1.0, 5.0, "S")],
        "msisdn string, periode string, mnt_topup double, arpu double, region_residence string",
    )
    columns = {n: F.lit(6.0) for n in names if n != "mnt_topup"} | {
        "anciennete_mois": F.lit(None).cast("double"),
        "usage_cashin": F.lit(1.0),
        "nb_topup": F.lit(0.0),
    }
    features = base.withColumns(columns)
    centres = {i: [float(i)] * len(U.MODEL_FEATURES) for i in range(7)}
    result = segments.wallet_segments(features, cohort, centres, ("202401", "202402"))
    got = {r["msisdn"]: r for r in result.collect()}
    assert set(got) == {phone(1), phone(2)}
    one = got[phone(1)]
    assert one["mnt_topup"] == 0.0 and one["mnt_transactions"] == 54.0
    assert one["mnt_transactions_my"] == 9.0 and one["mnt_transactions_max"] == 48.0
    assert one["region_residence"] is None and one["anciennete_mois"] is None
    assert one["service_cash"] == 1 and one["service_irt"] == 0 and one["service_top_up"] == 0
    assert one["service"] == 3
    # distance to centre c: 21 * (6 - c)^2 + 2 * c^2, and (3 - c)^2 for the filled top-up
    assert (one["label"], one["categorie"], one["cluster"]) == (5, "S12", "1")
    two = got[phone(2)]
    assert (two["label"], two["categorie"], two["cluster"]) == (6, "S52", "5")
    assert len(result.columns) == len(set(result.columns))
