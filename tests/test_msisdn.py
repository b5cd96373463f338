import pytest
from pyspark.sql import functions as F

from ridgeway.functions import msisdn as N

NUMBERS = [
    "07123456", "0712345678", "22507123456", "2250712345678", "123", None, "abc",
    "33612345678", "05412345", "22505412345", "09912345", "22509912345",
    "2250541234567", "12345678", "225", "700000012", "0022512345678",
]


@pytest.fixture(scope="module")
def normalise(spark):
    frame = spark.createDataFrame([(n,) for n in NUMBERS], "number string")

    def run(function, **options):
        result = frame.select("number", function(F.col("number"), **options).alias("out"))
        return {r["number"]: r["out"] for r in result.collect()}

    return run


def test_canonical_takes_the_last_eight_digits_and_never_pads(normalise):
    out = normalise(N.canonical)
    assert out["07123456"] == "2250707123456"
    assert out["2250712345678"] == "2250712345678"
    assert out["0712345678"] == "2250712345678"
    assert out["123"] == "22507123"
    assert out[None] is None


def test_operator_class_follows_the_second_digit(normalise):
    out = normalise(N.by_operator_class)
    assert out["05412345"] == "2250505412345"
    assert out["22505412345"] == "2250505412345"
    assert out["09912345"] == "2250709912345"
    assert out["22509912345"] == "2250709912345"
    assert out["0712345678"] == "2250712345678"
    assert out["225"] == "225"
    assert out["12345678"] is None and out["abc"] is None and out[None] is None


def test_operator_class_of_national_eight_digit_numbers_keeps_all_eight(normalise):
    # as written, the source cut an 8-digit number to its last five digits
    assert normalise(N.by_operator_class, strict=True)["05412345"] == "2250505412345"


def test_strict_operator_class_wants_exact_lengths(normalise):
    out = normalise(N.by_operator_class, strict=True)
    assert out["22509912345"] == "2250709912345"
    assert out["2250541234567"] == "2250541234567"
    assert out["0712345678"] is None
    assert out["225"] is None


def test_by_length(normalise):
    out = normalise(N.by_length)
    assert out["22507123456"] == "2250707123456"
    assert out["2250712345678"] == "2250712345678"
    assert out["0712345678"] is None and out[None] is None


def test_with_country_code(normalise):
    out = normalise(N.with_country_code)
    assert out["700000012"] == "2250700000012"
    assert out["0712345678"] == "2250712345678"
    assert out["123"] == "123"


def test_canonical_if_local_leaves_foreign_numbers_alone(normalise):
    out = normalise(N.canonical_if_local)
    assert out["33612345678"] == "33612345678"
    assert out["0022512345678"] == "2250712345678"
    assert out["0712345678"] == "2250712345678"
    assert out[None] is None


def test_mark_foreign(normalise):
    out = normalise(N.mark_foreign)
    assert out["33612345678"] == "EXT"
    assert out["0022512345678"] == "0022512345678"
    assert out[None] is None
