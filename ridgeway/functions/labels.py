"""Code-to-label mappings and rule-based classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Code lists, word lists, band borders and labels of the
# delivered files.
# ---------------------------------------------------------------------------
SUBSCRIBER_TYPES = {"1": "PREPAID", "2": "POSTPAID", "3": "HYBRID", "4": "OTHERS"}
SUBSCRIBER_DEFAULT = "OTHERS"
SERVICES = {1: "DATA", 2: "VOIX", 4: "SMS", 10: "SVA", 512: "IMS"}
UNIVERSES = {1: "FIX", 2: "MOBILE", 3: "INTERNET", 4: "MOBILE/BANKING"}
UNKNOWN = "UNKNOWN"

DATA_WORDS = ("DATA", "MB", "GB")
CALL_WORDS = ("MINUTE", "HOUR", "DAY", "WEEK", "MONTH")

TAG_CHANNELS = ("5", "30")
RECHARGE_TAGS = {
    "sos_credit": "EMERGENCY CREDIT",
    "sos_data": "EMERGENCY DATA",
    "other_recharge": "",
}

ZERO_VALUE = "ZERO_VALUE"
VALUE_BANDS = (
    (1000, "VERY_LOW_VALUE - ]0-1000]"),
    (2500, "LOW_VALUE - ]1000-2500]"),
    (5000, "MIDDLE_VALUE - ]2500-5000]"),
    (10000, "MIDDLE_HIGH_VALUE - ]5000-10000]"),
    (50000, "HIGH_VALUE - ]10000-50000]"),
)
TOP_VALUE = "VERY_HIGH_VALUE - ]50000++["

ZERO_RATIO = "ZERO"
RATIO_BANDS = ((0.1, "]0 - 10%]"), (0.3, "]10% - 30%]"), (0.5, "]30% - 50%]"))
TOP_RATIO = "]50% & ++["

COMMUNITY_PROFILES = ("%COMMUNITY%", "SP_D_BR_NOVA")
STAFF_PROFILES = ("SP_D_OI%", "%PERSONNEL%", "%TEST%", "%2007", "%INTERNE%")
CLIENT_TYPES = (("%HYBRID%", "HYBRIDE-AUTRE"), ("%POSTP%", "POSTPAID"))
NAMED_PLANS = (
    ("ANIMALS-", ("DAUPHIN", "COLIBRI", "TIGRE", "AIGLE")),
    ("NOVAMIX-", ("KIT_ELITE", "KIT_CLASSIC", "TOGO-TOGO", "KIT_JEUNE")),
    ("AGM-", ("MAXY", "PROXY", "LIBERTY", "BARA", "MAGALI")),
)
PATTERN_PLANS = (("%NEO%SECOND%", "AGM-NEO_SECONDE"), ("%ORANG%INA%", "AGM-FUN_INTENS"))
COMMUNITY_LABEL = "HYBRIDE-COMMUNITY"
STAFF_LABEL = "HYBRIDE-PERSONNEL"
OTHER_PLAN = "PREPAID-AUTRES"

TERMINAL_4G, TERMINAL_3G, TERMINAL_2G, TERMINAL_NONE = "4G", "3G", "2G", "INCONNU"


def code_label(code: Column, labels: Mapping, default: str | None) -> Column:
    """Label of a code; anything unlisted, NULL included, gets the default."""
    result = F.lit(None).cast("string") if default is None else F.lit(default)
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    # try_element_at: NULL for an unknown key, also with ANSI mode on
    return F.coalesce(F.try_element_at(known, code), result)


def subscriber_label(code: Column) -> Column:
    return code_label(code.cast("string"), SUBSCRIBER_TYPES, SUBSCRIBER_DEFAULT)


def service_label(code: Column) -> Column:
    return code_label(code.try_cast("int"), SERVICES, UNKNOWN)


def universe_label(code: Column) -> Column:
    return code_label(code.try_cast("int"), UNIVERSES, UNKNOWN)


def has_label(code: Column, labels: Mapping[int, str], label: str) -> Column:
    """Whether a code has a label, as a condition on the bare code column, which
    reaches the scan. ``UNKNOWN`` stands for codes without label and for NULL."""
    if label == UNKNOWN:
        return code.isNull() | ~code.isin(*labels)
    codes = [c for c, name in labels.items() if name == label]
    if not codes:
        raise ValueError(f"unknown label {label!r}")
    return code.isin(*codes) if len(codes) > 1 else code == codes[0]


def account_charge(accounts: Sequence[Column], charges: Sequence[Column]) -> Column:
    """Sum of the charges booked on account type 1, in whole currency units."""
    total = F.lit(0.0)
    for account, charge in zip(accounts, charges, strict=True):
        total = total + F.when(account == 1, charge).otherwise(F.lit(0.0))
    return total / 100


def benefit_flags(benefit: Column) -> dict[str, Column]:
    """Four exclusive 0/1 indicators of a subscribed benefit.

    ``data``: a data word only; ``appel_sms``: a call word or any digit only;
    ``mix``: both; ``others``: neither, NULL included.
    """
    text = F.upper(F.coalesce(benefit, F.lit("")))
    data = text.rlike("|".join(DATA_WORDS))
    call = text.rlike("|".join(CALL_WORDS) + "|[0-9]")
    return {
        "data": (data & ~call).cast("double"),
        "mix": (data & call).cast("double"),
        "appel_sms": (call & ~data).cast("double"),
        "others": (~data & ~call).cast("double"),
    }


def tag_match(channel: Column, benefit: Column, tag: str) -> Column:
    """Row paid through a loan channel for the tagged benefit (never NULL)."""
    hit = channel.cast("string").isin(*TAG_CHANNELS) & (F.upper(benefit) == tag.upper())
    return F.coalesce(hit, F.lit(False))


def tag_value(channel: Column, benefit: Column, value: Column, tag: str) -> Column:
    """The value on matching rows, 0 elsewhere; an empty tag keeps every value."""
    if tag == "":
        return value
    return F.when(tag_match(channel, benefit, tag), value).otherwise(F.lit(0.0))


def value_band(total: Column) -> Column:
    """Spend band with closed upper borders; negatives fall in the first band."""
    result = F.when(total == 0, ZERO_VALUE)
    for border, label in VALUE_BANDS:
        result = result.when(total <= border, label)
    return result.when(total > VALUE_BANDS[-1][0], TOP_VALUE)


def ratio_band(numerator: Column, denominator: Column) -> Column:
    """Share band; the zero test comes first, so no division by zero happens."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    result = F.when(denominator == 0, ZERO_RATIO)
    for border, label in RATIO_BANDS:
        result = result.when(ratio <= border, label)
    return result.when(ratio > RATIO_BANDS[-1][0], TOP_RATIO)


def _like_any(text: Column, patterns: Sequence[str]) -> Column:
    hit = text.like(patterns[0])
    for pattern in patterns[1:]:
        hit = hit | text.like(pattern)
    return hit


def tariff_family(profile: Column, client_type: Column) -> Column:
    """Tariff-plan family; the first matching rule wins."""
    name, kind = F.upper(profile), F.upper(client_type)
    result = F.when(_like_any(name, COMMUNITY_PROFILES), COMMUNITY_LABEL)
    result = result.when(_like_any(name, STAFF_PROFILES), STAFF_LABEL)
    for pattern, label in CLIENT_TYPES:
        result = result.when(kind.like(pattern), label)
    for prefix, names in NAMED_PLANS:
        result = result.when(name.isin(*names), F.concat(F.lit(prefix), name))
    for pattern, label in PATTERN_PLANS:
        result = result.when(name.like(pattern), label)
    return result.otherwise(OTHER_PLAN)


def terminal_generation(kind: Column, volume_4g: Column) -> Column:
    """Network generation of a handset; 4G traffic outranks the declared type."""
    code = F.coalesce(kind, F.lit(0))
    return (
        F.when((code == 4) | (volume_4g > 0), TERMINAL_4G)
        .when(code.isin(1, 2), TERMINAL_2G)
        .when(code == 3, TERMINAL_3G)
        .when(code == 0, TERMINAL_NONE)
    )


def kb_to_mb(value: Column) -> Column:
    return value / 1024


def positive_flag(value: Column) -> Column:
    return F.when(value > 0, 1).otherwise(0)


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def iso_week_year(ts: Column) -> Column:
    """Year the ISO week belongs to, for ranges that span New Year."""
    return F.extract(F.lit("YEAROFWEEK"), ts)
