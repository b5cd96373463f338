"""What the wallet graph's indicators keep of its edges."""

from datetime import date

from ridgeway.plans import social


def test_only_the_columns_that_are_read_again_are_kept(spark, monkeypatch):
    kept = []
    keep = social.materialise
    monkeypatch.setattr(social, "materialise", lambda df: (kept.append(df.columns), keep(df))[1])
    ends = [("a", "b"), ("b", "c"), ("c", "a"), ("b", "a")]
    number = {"a": "0700000001", "b": "0700000002", "c": "0700000003"}
    data = [
        (number[s], number[d], "TS", None, "SUBS", "SUBS", 10.0, 1.0, tag, date(2024, 1, 9))
        for s, d in ends
        for tag in ("X", "Y")
    ]
    frame = spark.createDataFrame(
        data,
        "sender_msisdn string, receiver_msisdn string, transaction_status string, rollbacked string,"
        "sender_category_code string, receiver_category_code string, transaction_amount double,"
        "service_charge_amount double, transaction_tag string, transaction_date_time date",
    )
    cohort = spark.createDataFrame([(f"22507{n[2:]}",) for n in number.values()], "phone string")
    found = social.wallet_graph_indicators(frame, cohort, ("20240101", "20240131"))
    assert {r["msisdn"][-1]: (r["sum_in"], r["out_degree"], r["n_triangles"]) for r in found.collect()} == {
        "1": (40.0, 2, 1), "2": (20.0, 4, 1), "3": (20.0, 2, 1)
    }
    (columns,) = kept
    assert {"src", "dst", "total_transaction"} <= set(columns)
    assert not {"transaction_tag", "nbr_transactions", "total_service_charge"} & set(columns)
