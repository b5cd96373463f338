"""Derived usage measures of a subscriber's wallet activity."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The columns that enter each derived measure. Names are the
# feature table's own, matched without regard to case.
MONTHS_COVERED = 6
AMOUNTS = (
    "mnt_irtin", "mnt_irtout", "mnt_paiementfacture", "mnt_b2win", "mnt_b2wout",
    "mnt_cashin", "mnt_cashout", "mnt_p2pin", "mnt_p2pout", "mnt_topup",
)
PEAK_SERVICES = (
    "irtin", "irtout", "b2win", "b2wout", "cashin", "cashout", "p2pin", "p2pout",
)
SERVICE_USAGE = {
    "service_cash": ("usage_cashin", "usage_cashout"),
    "service_irt": ("usage_irtin", "usage_irtout"),
    "service_p2p": ("usage_p2p_in", "usage_p2p_out"),
    "service_voc": ("usage_b2wout", "usage_b2win"),
}
BILL_USAGE = "usage_paiementfacture"
SCHOOL_USAGE = "usage_frais_sco"
TOPUP_COUNT = "nb_topup"
MODEL_FEATURES = (
    "mnt_irtin", "nb_irtin", "mnt_irtout", "nb_irtout", "mnt_paiementfacture",
    "nb_paiementfacture", "mnt_b2win", "mnt_b2wout", "nb_b2wout", "mnt_p2pout",
    "nb_p2pout", "mnt_cashin", "nb_cashin", "mnt_p2pin", "nb_p2pin", "mnt_cashout",
    "nb_cashout", "mnt_topup", "nb_topup", "mnt_transact_in", "nb_transact_in",
    "mnt_transact_out", "nb_transact_out",
)


def filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def add_up(names: Iterable[str]) -> Column:
    """Row-wise sum with NULL read as zero."""
    total = F.lit(0)
    for name in names:
        total = total + filled(name)
    return total


def amount_measures() -> dict[str, Column]:
    """Six-month total, its monthly mean, and the summed service peaks."""
    total = add_up(AMOUNTS)
    return {
        "mnt_transactions": total,
        "mnt_transactions_my": total / MONTHS_COVERED,
        "mnt_transactions_max": add_up(f"max_{s}" for s in PEAK_SERVICES),
        "mnt_transactions_min": add_up(f"min_{s}" for s in PEAK_SERVICES),
    }


def service_measures() -> dict[str, Column]:
    """One 0/1 flag per service and the number of services in use."""
    flags = {
        name: F.greatest(*[(filled(c) == 1).cast("int") for c in columns])
        for name, columns in SERVICE_USAGE.items()
    }
    flags["service_abon"] = filled(BILL_USAGE)
    flags["service_frais"] = filled(SCHOOL_USAGE)
    flags["service_top_up"] = (filled(TOPUP_COUNT) != 0).cast("int")
    in_use = F.lit(0)
    for flag in flags.values():
        in_use = in_use + (flag != 0).cast("int")
    return {**flags, "service": in_use}
