import pytest
from pyspark.sql import functions as F

from ridgeway.functions import labels as L


def values(spark, schema, data, column):
    frame = spark.createDataFrame(data, schema)
    return [r[0] for r in frame.select(column.alias("x")).collect()]


def test_subscriber_label_defaults_unknown_and_null(spark):
    data = [("1",), ("2",), ("3",), ("4",), ("9",), (None,)]
    assert values(spark, "c string", data, L.subscriber_label(F.col("c"))) == [
        "PREPAID", "POSTPAID", "HYBRID", "OTHERS", "OTHERS", "OTHERS",
    ]


def test_service_and_universe_labels(spark):
    data = [(1,), (2,), (4,), (10,), (512,), (3,), (None,)]
    assert values(spark, "c int", data, L.service_label(F.col("c"))) == [
        "DATA", "VOIX", "SMS", "SVA", "IMS", "UNKNOWN", "UNKNOWN",
    ]
    assert values(spark, "c int", [(4,), (0,)], L.universe_label(F.col("c"))) == [
        "MOBILE/BANKING",
        "UNKNOWN",
    ]


def test_account_charge_counts_only_account_type_one(spark):
    data = [(1, 2, 100.0, 50.0), (1, 1, 100.0, 50.0), (None, 1, 100.0, 50.0)]
    charge = L.account_charge([F.col("a"), F.col("b")], [F.col("x"), F.col("y")])
    assert values(spark, "a int, b int, x double, y double", data, charge) == [1.0, 1.5, 0.5]


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (None, "others"), ("500MB", "mix"), ("DATA", "data"), ("data plus", "data"),
        ("1 DAY", "appel_sms"), ("weekend", "appel_sms"), ("plain", "others"), ("7", "appel_sms"),
    ],
)
def test_benefit_flags_are_exclusive(spark, text, kind):
    flags = L.benefit_flags(F.col("b"))
    frame = spark.createDataFrame([(text,)], "b string")
    row = frame.select(*[c.alias(n) for n, c in flags.items()]).first().asDict()
    assert row == {n: float(n == kind) for n in flags}


def test_tag_value_ignores_case_and_keeps_everything_for_an_empty_tag(spark):
    data = [
        (5, "Emergency Credit", 10.0), (30, "EMERGENCY CREDIT", 4.0), (7, "EMERGENCY CREDIT", 3.0),
        (5, None, 2.0), (None, "EMERGENCY CREDIT", 1.0),
    ]
    columns = F.col("c"), F.col("b"), F.col("v")
    schema = "c int, b string, v double"
    tagged = values(spark, schema, data, L.tag_value(*columns, "EMERGENCY CREDIT"))
    assert tagged == [10.0, 4.0, 0.0, 0.0, 0.0]
    assert values(spark, schema, data, L.tag_value(*columns, "")) == [10.0, 4.0, 3.0, 2.0, 1.0]


def test_value_band_borders(spark):
    data = [(v,) for v in (0.0, -5.0, 1000.0, 1000.01, 2500.0, 5000.0, 10000.0, 50000.0, 50001.0)]
    data.append((None,))
    bands = values(spark, "v double", data, L.value_band(F.col("v")))
    assert [b and b.split(" ")[0] for b in bands] == [
        "ZERO_VALUE", "VERY_LOW_VALUE", "VERY_LOW_VALUE", "LOW_VALUE", "LOW_VALUE", "MIDDLE_VALUE",
        "MIDDLE_HIGH_VALUE", "HIGH_VALUE", "VERY_HIGH_VALUE", None,
    ]


def test_ratio_band_with_zero_denominator(spark):
    data = [(1.0, 0.0), (1.0, 10.0), (3.0, 10.0), (5.0, 10.0), (6.0, 10.0), (None, 5.0)]
    assert values(spark, "a double, b double", data, L.ratio_band(F.col("a"), F.col("b"))) == [
        "ZERO", "]0 - 10%]", "]10% - 30%]", "]30% - 50%]", "]50% & ++[", None,
    ]


@pytest.mark.parametrize(
    ("profile", "kind", "family"),
    [
        ("my community", "POSTPAID", "HYBRIDE-COMMUNITY"),
        ("SPxDxBRxNOVA", None, "HYBRIDE-COMMUNITY"),
        ("sp_d_oi_x", None, "HYBRIDE-PERSONNEL"),
        ("abc2007", "HYBRID", "HYBRIDE-PERSONNEL"),
        ("maxy", "a hybrid one", "HYBRIDE-AUTRE"),
        ("maxy", "postpaid", "POSTPAID"),
        ("maxy", "prepaid", "AGM-MAXY"),
        ("tigre", None, "ANIMALS-TIGRE"),
        ("togo-togo", None, "NOVAMIX-TOGO-TOGO"),
        ("neo x second", None, "AGM-NEO_SECONDE"),
        ("orangina", None, "AGM-FUN_INTENS"),
        (None, None, "PREPAID-AUTRES"),
    ],
)
def test_tariff_family_first_rule_wins(spark, profile, kind, family):
    column = L.tariff_family(F.col("p"), F.col("t"))
    assert values(spark, "p string, t string", [(profile, kind)], column) == [family]


def test_terminal_generation(spark):
    data = [(4, 0.0), (1, 5.0), (1, 0.0), (2, None), (3, 0.0), (None, 0.0), (0, None), (5, 0.0)]
    column = L.terminal_generation(F.col("k"), F.col("v"))
    assert values(spark, "k int, v double", data, column) == [
        "4G", "4G", "2G", "2G", "3G", "INCONNU", "INCONNU", None,
    ]


def test_iso_week_around_new_year(spark):
    frame = spark.sql("select timestamp_ntz'2021-01-03 10:00:00' as t")
    row = frame.select(L.iso_week("t").alias("w"), L.iso_week_year("t").alias("y")).first()
    assert (row["w"], row["y"]) == (53, 2020)
