"""Independent SQL for the registered queries (DuckDB dialect)."""

from __future__ import annotations

from harness.source_sql import (
    LINE,
    LOCAL,
    TABLES,
    WRITTEN,
    number,
    profile_name,
    with_tables,
)
from harness.usage_features import HIGH, KINDS, LOW, PEAKS, USAGES, centroids

IN_COHORT = "IN (SELECT phone FROM cohort)"
IN_LINES = "IN (SELECT phone FROM line_cohort)"
ORDER_DAYS = ">= DATE '1995-01-01' AND {0} < DATE '2002-01-01'"
POINTS = ((0, "p0"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (1, "p100"))


def r(expression: str) -> str:
    """Same rounding as on the Spark side."""
    return f"round(CAST({expression} AS DOUBLE) + 1e-6, 2)"


def described(metric: str, expression: str | None = None, sums: bool = False) -> str:
    x = expression or metric
    columns = [f"{r(f'sum({x})')} AS {metric}_sum"] if sums else []
    columns += [f"{r(f'avg({x})')} AS {metric}_avg", f"{r(f'stddev_samp({x})')} AS {metric}_std"]
    columns += [f"{r(f'quantile_cont({x}, {q})')} AS {metric}_{name}" for q, name in POINTS]
    return ", ".join(columns)


def by_class(number: str, strict: bool = False) -> str:
    rest, kept = ("[0-9]{6}", "[0-9]{10}") if strict else ("[0-9]*", "[0-9]*")
    branches = " ".join(
        f"WHEN regexp_matches({number}, '^(225)?[04-9]{second}{rest}$')"
        f" THEN '{prefix}' || right({number}, 8)"
        for prefix, second in (("22501", "[0-3]"), ("22505", "[4-6]"), ("22507", "[7-9]"))
    )
    return f"CASE {branches} WHEN regexp_matches({number}, '^225{kept}$') THEN {number} END"


def by_length(number: str) -> str:
    return (
        f"CASE length({number}) WHEN 11 THEN '22507' || substr({number}, 4, 8)"
        f" WHEN 13 THEN {number} END"
    )


# Columns of the activity file.
ACTIVITY = (
    "datedata", "balombeg", "balomend", "nbcashin", "volcashin", "nbcashout",
    "volcashout", "nbcharge", "nbp2pin", "volp2pin", "nbp2pout", "volp2pout",
    "nbmerpay", "volmerpay", "nbbillpay", "volbillpay", "nbotherin", "volotherin",
    "nbotherout", "volotherout", "nbp2pphonein", "nbp2pphoneout", "nbtotalcharge",
    "voltotalcharge", "nbcall", "timecall", "nbsms", "nbcontactcallin",
    "nbcontactcallout", "nbcontactsms", "geoloccomm", "geolocnight",
    "preferedagent", "preferedagentqual", "mmdate", "devicetype", "group_id",
)

# Fixed values of the expected labels, written out again so that a slip in the
# library does not repeat itself here.
SPEND_LABELS = (
    (0, 0, "ZERO_VALUE"),
    (None, 1000, "VERY_LOW_VALUE - ]0-1000]"),
    (1000, 2500, "LOW_VALUE - ]1000-2500]"),
    (2500, 5000, "MIDDLE_VALUE - ]2500-5000]"),
    (5000, 10000, "MIDDLE_HIGH_VALUE - ]5000-10000]"),
    (10000, 50000, "HIGH_VALUE - ]10000-50000]"),
    (50000, None, "VERY_HIGH_VALUE - ]50000++["),
)
SHARE_LABELS = (
    (None, 0.1, "]0 - 10%]"),
    (0.1, 0.3, "]10% - 30%]"),
    (0.3, 0.5, "]30% - 50%]"),
    (0.5, None, "]50% & ++["),
)
PLAN_LABELS = (
    ("profile", "%COMMUNITY%", "HYBRIDE-COMMUNITY"),
    ("profile", "SP_D_BR_NOVA", "HYBRIDE-COMMUNITY"),
    ("profile", "SP_D_OI%", "HYBRIDE-PERSONNEL"),
    ("profile", "%PERSONNEL%", "HYBRIDE-PERSONNEL"),
    ("profile", "%TEST%", "HYBRIDE-PERSONNEL"),
    ("profile", "%2007", "HYBRIDE-PERSONNEL"),
    ("profile", "%INTERNE%", "HYBRIDE-PERSONNEL"),
    ("type", "%HYBRID%", "HYBRIDE-AUTRE"),
    ("type", "%POSTP%", "POSTPAID"),
    ("profile", "DAUPHIN", "ANIMALS-DAUPHIN"),
    ("profile", "COLIBRI", "ANIMALS-COLIBRI"),
    ("profile", "TIGRE", "ANIMALS-TIGRE"),
    ("profile", "AIGLE", "ANIMALS-AIGLE"),
    ("profile", "KIT_ELITE", "NOVAMIX-KIT_ELITE"),
    ("profile", "KIT_CLASSIC", "NOVAMIX-KIT_CLASSIC"),
    ("profile", "TOGO-TOGO", "NOVAMIX-TOGO-TOGO"),
    ("profile", "KIT_JEUNE", "NOVAMIX-KIT_JEUNE"),
    ("profile", "MAXY", "AGM-MAXY"),
    ("profile", "PROXY", "AGM-PROXY"),
    ("profile", "LIBERTY", "AGM-LIBERTY"),
    ("profile", "BARA", "AGM-BARA"),
    ("profile", "MAGALI", "AGM-MAGALI"),
    ("profile", "%NEO%SECOND%", "AGM-NEO_SECONDE"),
    ("profile", "%ORANG%INA%", "AGM-FUN_INTENS"),
)
OTHER_PLAN = "PREPAID-AUTRES"
# Features of the segment model.
MODEL_COLUMNS = (
    "mnt_irtin", "nb_irtin", "mnt_irtout", "nb_irtout", "mnt_paiementfacture",
    "nb_paiementfacture", "mnt_b2win", "mnt_b2wout", "nb_b2wout", "mnt_p2pout", "nb_p2pout",
    "mnt_cashin", "nb_cashin", "mnt_p2pin", "nb_p2pin", "mnt_cashout", "nb_cashout",
    "mnt_topup", "nb_topup", "mnt_transact_in", "nb_transact_in", "mnt_transact_out",
    "nb_transact_out",
)


def lookup(rows: list[str], columns: str, condition: str) -> str:
    """Label of the first row of a table of rules whose condition holds."""
    numbered = ", ".join(f"({place}, {row})" for place, row in enumerate(rows))
    return f"""(SELECT arg_min(rule.label, rule.place)
        FROM (VALUES {numbered}) rule(place, {columns}) WHERE {condition})"""


def band(x: str, borders) -> str:
    """Label of the interval that holds ``x``; lower ends are open, so that the interval
    with the lower place takes its upper border."""
    rows = []
    for low, high, label in borders:
        low = "-1e300" if low is None else low
        high = "1e300" if high is None else high
        rows.append(f"CAST({low} AS DOUBLE), CAST({high} AS DOUBLE), '{label}'")
    return lookup(rows, "low, high, label", f"{x} BETWEEN rule.low AND rule.high")


def value_band(x: str) -> str:
    return band(x, SPEND_LABELS)


def ratio_band(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 'ZERO' ELSE {band(f'({a} / {b})', SHARE_LABELS)} END"


def tariff(profile: str, kind: str) -> str:
    rows = [f"'{field}', '{pattern}', '{label}'" for field, pattern, label in PLAN_LABELS]
    seen = f"CASE rule.field WHEN 'profile' THEN {profile} ELSE {kind} END"
    found = lookup(rows, "field, pattern, label", f"{seen} LIKE rule.pattern")
    return f"coalesce({found}, '{OTHER_PLAN}')"


def wireless(kind: str, snapshot: str) -> str:
    return f"""SELECT {by_class('second_contact')} AS msisdn, plan_tarifaire,
        '{kind}' AS debit, categorie, categorie_client, ville, numero FROM fixed_lines
        WHERE {by_class('second_contact')} {IN_LINES} AND date_jour = '{snapshot}'"""


def wired(snapshot: str) -> str:
    return f"""SELECT DISTINCT msisdn, plan_tarifaire, debit, categorie,
        categorie_client, etat, ville, numero FROM (
          SELECT *, {by_class('contact')} AS msisdn FROM fixed_lines
          UNION ALL SELECT *, {by_class('second_contact')} FROM fixed_lines)
        WHERE msisdn {IN_LINES} AND date_jour = '{snapshot}'"""


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y%m%d')"


MONDAY = "CAST(date_trunc('week', o_orderdate) AS DATE)"


def per_period(periods: str) -> str:
    """Orders counted per period; ``periods`` selects start and end per order."""
    return f"""SELECT {day('s')} AS period_start, {day('e')} AS period_end,
        count(*) AS n_orders, {r('sum(o_totalprice)')} AS total
        FROM ({periods}) GROUP BY s, e"""


def wallet_arpu() -> str:
    return f"""SELECT msisdn, is_send, count(service_charge) AS n_transactions,
        {described('service_charge')}
        FROM parties WHERE msisdn {IN_COHORT}
          AND transaction_date_time {ORDER_DAYS.format('transaction_date_time')}
        GROUP BY msisdn, is_send"""


def transfers(zero: str, counts: str) -> str:
    return f"""SELECT msisdn, {counts}, {described('transfer_in')}, {described('transfer_out')}
        FROM (
          SELECT '22507' || right(sender_msisdn, 8) AS msisdn, {zero} AS transfer_in,
                 transfer_value AS transfer_out
          FROM credit_transfers WHERE final_transfer_status_lv NOT IN (5, 6)
          UNION ALL
          SELECT '22507' || right(receiver_msisdn, 8), transfer_value, {zero}
          FROM credit_transfers WHERE final_transfer_status_lv NOT IN (5, 6))
        WHERE msisdn {IN_COHORT} GROUP BY msisdn"""


AMOUNTS = ("amount", "initial_loan", "already_paid_back", "remain_to_pay_back")
TAGS = {"sos_credit": "EMERGENCY CREDIT", "sos_data": "EMERGENCY DATA"}


def recharge_tags(strict: bool) -> str:
    nothing = "NULL" if strict else "0"
    columns = []
    for name, tag in TAGS.items():
        hit = f"channel IN (5, 30) AND tag = '{tag}'"
        for a in AMOUNTS:
            value = f"CASE WHEN {hit} THEN {a} ELSE {nothing} END"
            if a == "amount":
                columns.append(f"count({value}) AS n_{name}")
            columns.append(described(f"{name}_{a}", value))
    loan = "channel IN (5, 30) AND tag IS NOT NULL"
    for a in AMOUNTS:
        value = f"CASE WHEN {loan} THEN NULL ELSE {a} END" if strict else a
        if a == "amount":
            columns.append(f"count({value}) AS n_other_recharge")
        columns.append(described(f"other_recharge_{a}", value))
    return f"""SELECT msisdn, subscriber_type, {', '.join(columns)}
        FROM recharges WHERE msisdn {IN_COHORT} GROUP BY msisdn, subscriber_type"""


def peer_stats(
    service: str, weight: str, label: str, keys: str = "category", source: str = "categorised"
) -> str:
    def side(end: str, name: str) -> str:
        return f"""SELECT {keys}, {end} AS msisdn, count(w) AS n_peers_{label}_{name},
            min(w) AS min_{label}_{name}, max(w) AS max_{label}_{name},
            {r('avg(w)')} AS avg_{label}_{name}, {r('stddev_samp(w)')} AS std_{label}_{name},
            CAST(sum(w) AS BIGINT) AS sum_{label}_{name} FROM e GROUP BY {keys}, {end}"""

    body = f"""SELECT * FROM ({side('src', 'out')}) JOIN ({side('dst', 'in')})
        USING ({keys}, msisdn) WHERE msisdn {IN_COHORT}"""
    edges = f"""SELECT {keys}, src, dst, CAST({weight} AS BIGINT) AS w FROM {source}
        WHERE service = '{service}' AND universe = 'MOBILE' GROUP BY {keys}, src, dst"""
    return with_tables(body.replace("FROM e ", f"FROM ({edges}) "))


def peers() -> str:
    edges = """SELECT category, src, dst, count(*) AS n FROM categorised
        WHERE service = 'VOIX' AND universe = 'MOBILE' GROUP BY category, src, dst"""

    def side(own: str, peer: str, name: str, count: str) -> str:
        return f"""SELECT category, {own} AS msisdn, count({peer}) AS {count},
            CAST(sum(n) AS BIGINT) AS msg_{name}_sum, {described(f'msg_{name}', 'n')}
            FROM ({edges}) GROUP BY category, {own}"""

    return f"""SELECT * FROM (SELECT phone AS msisdn, unnest(['local', 'inter', 'roaming']) AS category
          FROM cohort)
        LEFT JOIN ({side('dst', 'src', 'in', 'nbr_src')}) USING (category, msisdn)
        LEFT JOIN ({side('src', 'dst', 'out', 'nbr_dst')}) USING (category, msisdn)"""


def in_out(edges: str, weight: str) -> str:
    def side(end: str, name: str) -> str:
        return f"""SELECT {end} AS id, {r(f'sum({weight})')} AS sum_{name},
            {r(f'max({weight})')} AS max_{name}, {r(f'min({weight})')} AS min_{name},
            {r(f'avg({weight})')} AS avg_{name}, count({weight}) AS count_{name},
            count(*) AS {name}_degree FROM {edges} GROUP BY {end}"""

    return f"SELECT * FROM ({side('dst', 'in')}) JOIN ({side('src', 'out')}) USING (id)"


def features_sql() -> str:
    columns = ["avg(o_totalprice) AS arpu"]
    for kind, line in KINDS.items():
        value = (
            f"CASE WHEN l_linenumber = {line} AND l_quantity BETWEEN {LOW} AND {HIGH}"
            " THEN l_extendedprice END"
        )
        columns += [f"coalesce(sum({value}), 0) AS mnt_{kind}", f"count({value}) AS nb_{kind}"]
        if kind in PEAKS:
            columns += [
                f"coalesce({f}({value}), 0) AS {f}_{kind}" for f in ("max", "min")
            ]
    grouped = f"SELECT o_custkey, {', '.join(columns)} FROM order_lines GROUP BY o_custkey"
    used = ", ".join(f"CAST(nb_{k} > 2 AS INTEGER) AS {u}" for u, k in USAGES.items())
    return f"SELECT *, {number('o_custkey')} AS msisdn, {used} FROM ({grouped})"


def value_segments(month: str | None = None) -> str:
    wanted = f"AND v.month_id = '{month}'" if month else ""
    return f"""SELECT '22507' || right(v.number, 8) AS msisdn, v.month_id,
            {value_band('spend')} AS segment_valeur, {tariff('profil', 'kind')} AS plan_tarifaire,
            {r('data_kb / 1024')} AS trafic_data_mo, {r('spend')} AS arpu_telco,
            nation AS nb_pass_data, {r('money + money + 1')} AS arpu_data,
            nation + 1 AS nb_pass_mix, {r('money / 2 + money / 4')} AS arpu_mix,
            {ratio_band('via_wallet', 'recharge')} AS taux_usage_om, type_terminal
            FROM (SELECT *, {by_length('raw')} AS number FROM value_datamart) v
            JOIN (SELECT *, {by_length('raw')} AS number FROM terminal_datamart) t
              ON v.number = t.number AND v.month_id = t.month_id
            WHERE '22507' || right(v.number, 8) {IN_COHORT} {wanted}"""


def measures_sql() -> str:
    kinds = [k for k in KINDS if not k.startswith("transact")]
    total = " + ".join(f"mnt_{k}" for k in kinds)
    either = {
        "service_cash": ("cashin", "cashout"),
        "service_irt": ("irtin", "irtout"),
        "service_p2p": ("p2p_in", "p2p_out"),
        "service_voc": ("b2wout", "b2win"),
    }
    flags = ", ".join(
        f"greatest(usage_{a}, usage_{b}) AS {name}" for name, (a, b) in either.items()
    )
    inner = f"""SELECT *, {total} AS mnt_transactions, ({total}) / 6 AS mnt_transactions_my,
        {' + '.join(f'max_{k}' for k in PEAKS)} AS mnt_transactions_max,
        {' + '.join(f'min_{k}' for k in PEAKS)} AS mnt_transactions_min, {flags},
        usage_paiementfacture AS service_abon, usage_frais_sco AS service_frais,
        CAST(nb_topup <> 0 AS INTEGER) AS service_top_up FROM ({features_sql()})"""
    parts = [*either, "service_abon", "service_frais", "service_top_up"]
    return f"SELECT *, {' + '.join(parts)} AS service FROM ({inner})"


def segments_sql() -> str:
    distances = ", ".join(
        "{'d': "
        + " + ".join(f"({f} - {v}) * ({f} - {v})" for f, v in zip(MODEL_COLUMNS, centre))
        + f", 'l': {label}}}"
        for label, centre in centroids(MODEL_COLUMNS).items()
    )
    month = "CAST(right(msisdn, 8) AS INTEGER) % 3 + 1"
    labelled = f"""SELECT *, '20240' || CAST({month} AS VARCHAR) AS month,
        list_min([{distances}]).l AS label FROM ({measures_sql()})
        WHERE msisdn {IN_COHORT} AND {month} >= 2"""
    meant = f"SELECT *, avg(arpu) OVER (PARTITION BY label) AS mean FROM ({labelled})"
    categorie = """CASE label WHEN 0 THEN CASE WHEN arpu <= mean THEN 'S11' ELSE 'S41' END
        WHEN 4 THEN CASE WHEN arpu <= mean THEN 'S21' ELSE 'S32' END
        WHEN 5 THEN CASE WHEN arpu >= mean THEN 'S12' ELSE 'S22' END
        WHEN 3 THEN CASE WHEN arpu <= mean THEN 'S42' ELSE 'S51' END
        WHEN 1 THEN CASE WHEN arpu >= mean THEN 'S31' ELSE 'S61' END
        WHEN 6 THEN CASE WHEN arpu <= mean THEN 'S52' ELSE 'S72' END
        ELSE 'S71' END"""
    split = f"SELECT *, {categorie} AS categorie FROM ({meant})"
    return f"""SELECT msisdn, month AS periode, {r('arpu')} AS arpu_om,
        {r('mnt_transactions')} AS mnt_transactions, service, label, categorie,
        substr(categorie, 2, 1) AS cluster FROM ({split})"""


def statements() -> dict[str, str]:
    c = "'22507' || right({0}, 8)"
    sql = {
        "wallet_profile": f"""SELECT msisdn, user_id, is_send, tag, category_code,
            other_category_code, count(pre_balance) AS n_transactions,
            {described('pre_balance')}, {described('post_balance')}, {described('amount')},
            {described('service_charge')} FROM parties WHERE msisdn {IN_COHORT}
            GROUP BY ALL""",
        "wallet_arpu": wallet_arpu(),
        "profile_large_groups": f"""SELECT l_returnflag, count(l_orderkey) AS n_lines,
            {described('l_extendedprice', sums=True)}, {described('l_tax', sums=True)}
            FROM lineitem GROUP BY l_returnflag""",
        "transfer_profile": transfers("0", "count(transfer_in) AS n_transfer_in"),
        "transfer_profile_per_direction": transfers(
            "NULL",
            "count(transfer_in) AS n_transfer_in, count(transfer_out) AS n_transfer_out",
        ),
        "recharge_weekly_profile": f"""SELECT CAST(isoyear(transfer_date_time) AS INTEGER) AS year_of_week,
            CAST(weekofyear(transfer_date_time) AS INTEGER) AS week_nb,
            '22507' || right(CAST(receiver_msisdn AS VARCHAR), 8) AS msisdn,
            lv_label AS type_transaction, count(transfer_amount) AS n_transfers,
            {described('transfer_amount')}, {described('commission')}
            FROM channel_tx LEFT JOIN code_list ON lv_code = kind
            WHERE status = '200' AND '22507' || right(CAST(receiver_msisdn AS VARCHAR), 8) {IN_COHORT}
            GROUP BY 1, 2, 3, 4""",
        "recharge_tag_profile": recharge_tags(False),
        "recharge_strict_tag_profile": recharge_tags(True),
        "subscription_mix": f"""SELECT msisdn, subscriber_type,
            CAST(count(*) FILTER (kind = '1') AS DOUBLE) AS nbr_souscription_data,
            CAST(count(*) FILTER (kind = '2') AS DOUBLE) AS nbr_souscription_mix,
            CAST(count(*) FILTER (kind = '3') AS DOUBLE) AS nbr_souscription_appel_sms,
            CAST(count(*) FILTER (kind IN ('4', '5')) AS DOUBLE) AS nbr_souscription_others
            FROM subscriptions WHERE msisdn {IN_COHORT} GROUP BY msisdn, subscriber_type""",
        "activity_extract": f"""SELECT {number('user_id')} AS mmid, event_id, event_type,
            {r('value')} AS value FROM events WHERE {number('user_id')} {IN_COHORT}""",
        "data_usage_profile": f"""SELECT {c.format('calling_nbr')} AS msisdn,
            count(bytes) AS n_sessions, {described('bytes')} FROM cdr
            WHERE bytes <> 0 AND {c.format('calling_nbr')} {IN_COHORT} GROUP BY 1""",
        "bill_payments": f"""SELECT {day('transaction_date_time')} AS period, msisdn, type_facture,
            count(*) AS nb_trx, {r('sum(transaction_amount)')} AS mtt_trx FROM (
              SELECT transaction_date_time, {c.format('sender_msisdn')} AS msisdn,
                     partenaires AS type_facture, transaction_amount
              FROM wallet_tx t JOIN partners p ON t.receiver_msisdn = p.msisdn
              WHERE transaction_status = 'TS' AND vas_id = 'FACTURES' AND offer_name <> 'Financier'
                AND end_date = DATE '9999-12-31' AND receiver_category_code <> 'PDVCAPAY'
                AND receiver_domain_code <> 'CAPAY'
              UNION ALL
              SELECT transaction_date_time, {c.format('sender_msisdn')}, 'CANAL+', transaction_amount
              FROM wallet_tx WHERE transaction_status = 'TS' AND commission_oca > 0
                AND receiver_category_code = 'PDVCAPAY' AND receiver_domain_code = 'CAPAY'
              UNION ALL
              SELECT transaction_date_time, {c.format('sender_msisdn')}, 'PAIEMENT ASSURANCE',
                     transaction_amount
              FROM wallet_tx t WHERE transaction_status = 'TS' AND EXISTS (
                SELECT 1 FROM partners p WHERE t.receiver_msisdn = p.msisdn
                  AND vas_id = 'FACTURES' AND offer_name = 'Financier'
                  AND end_date = DATE '9999-12-31'))
            WHERE msisdn {IN_COHORT} GROUP BY 1, 2, 3""",
        "value_segments": value_segments(),
        "backfill_value_segments": value_segments("202402"),
        "multi_flag": f"""SELECT msisdn, max(a) AS statut_msim_home, max(b) AS statut_msim_alpha,
            max(m) AS statut_msim_beta FROM (
              SELECT {by_class(f'({WRITTEN})', True)} AS msisdn,
                     CAST(c_nationkey % 2 = 0 AS INTEGER) AS a,
                     CAST(c_nationkey % 3 = 0 AS INTEGER) AS b,
                     CAST(c_nationkey % 5 = 0 AS INTEGER) AS m FROM customer
              UNION ALL
              SELECT {by_class(f"('225' || {LOCAL})", True)}, CAST(o_totalprice > 400000 AS INTEGER),
                     CAST(o_orderstatus = 'P' AND o_totalprice > 300000 AS INTEGER),
                     CAST(o_orderstatus = 'O' AND o_totalprice > 200000 AS INTEGER)
              FROM orders JOIN customer ON o_custkey = c_custkey)
            WHERE msisdn {IN_LINES} GROUP BY msisdn""",
        "fleet_flag": f"""SELECT {number('c_custkey')} AS msisdn,
            CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS statut_flotte_entreprise,
            {day('o_orderdate')} AS date_id FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')
              AND upper({profile_name('c_custkey')}) NOT LIKE '%SP%BR_NOVA%'
              AND upper({profile_name('c_custkey')}) NOT LIKE '%SP%COMMUNITY%'
              AND {number('c_custkey')} {IN_COHORT}""",
        "geo_location": f"""SELECT {number('c_custkey')} AS msisdn, r_name AS zone_commerciale,
            n_name AS region, lower(n_name) AS departement, c_mktsegment AS commune,
            lower(c_mktsegment) AS geolocalite, c_name AS quartier, '20240102' AS date_id
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey WHERE {number('c_custkey')} {IN_COHORT}
              AND c_custkey % 3 = 1""",
        "line_base_one_contact": wireless('FDD', '20240102'),
        "line_base_tdd": wireless('TDD', '20240103'),
        "line_base_two_contacts": wired('20240102'),
        "line_base_ftth": wired('20240103'),
        "backfill_locations": f"""SELECT {number('c_custkey')} AS msisdn,
            r_name AS zone_commerciale, n_name AS region, lower(n_name) AS departement,
            c_mktsegment AS commune, lower(c_mktsegment) AS geolocalite, c_name AS quartier,
            '2024010' || CAST(c_custkey % 3 + 1 AS VARCHAR) AS date_id
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey WHERE {number('c_custkey')} {IN_COHORT}
              AND c_custkey % 3 IN (1, 2)""",
        "backfill_wallet_arpu": f"""SELECT {day('s')} AS period_start, {day('s + 6')} AS period_end,
            msisdn, is_send, count(service_charge) AS n_transactions, {described('service_charge')}
            FROM parties JOIN (SELECT CAST(DATE '1998-06-08' - 7 * CAST(i AS INTEGER) AS DATE) AS s
              FROM range(0, 10) t(i))
            ON transaction_date_time >= s AND transaction_date_time < s + 7
            WHERE msisdn {IN_COHORT} GROUP BY s, msisdn, is_send""",
        "file_partitioned_csv": f"""SELECT {day("date_trunc('week', ts)")} || '_to_'
              || {day("date_trunc('week', ts) + INTERVAL 6 DAY")} AS period,
            count(*) AS n_rows, CAST(sum((event_id * 7) % 1009) AS BIGINT) AS total
            FROM events WHERE {number('user_id')} {IN_COHORT}
              AND ts >= DATE '2024-01-01' AND ts < DATE '2024-01-29' GROUP BY 1""",
        "file_plain_csv": f"""SELECT n_name AS region, count(*) AS n_rows,
            min({number('c_custkey')}) AS first_msisdn
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            WHERE {number('c_custkey')} {IN_COHORT} AND c_custkey % 3 = 1 GROUP BY n_name""",
        "file_cohort": """SELECT count(*) AS n_clients, min(phone) AS first, max(phone) AS last
            FROM cohort""",
        "wallet_arpu_range": f"""SELECT msisdn, is_send, count(service_charge) AS n_transactions,
            {described('service_charge')} FROM parties WHERE msisdn {IN_COHORT}
              AND transaction_date_time >= DATE '1997-03-01'
              AND transaction_date_time < DATE '1997-09-01' GROUP BY msisdn, is_send""",
        "activity_full_width": f"""SELECT {number('user_id')} AS mmid, ts AS datedata,
            {', '.join(f'(event_id * {i + 3}) % 1009 AS {n}' for i, n in enumerate(ACTIVITY) if i)}
            FROM events WHERE {number('user_id')} {IN_COHORT}
              AND ts >= DATE '2024-01-01' AND ts < DATE '2024-01-11'""",
        "activity_by_user": f"""SELECT {number('user_id')} AS mmid, ts AS datedata,
            {', '.join(f'(event_id * {i + 3}) % 1009 AS {n}' for i, n in enumerate(ACTIVITY) if 0 < i < len(ACTIVITY) - 1)}
            FROM events WHERE {number('user_id')} {IN_COHORT}
              AND ts >= DATE '2024-01-03' AND ts < DATE '2024-01-09'""",
        "msisdn_normalise_all": f"""SELECT c_custkey, number, {c.format('number')} AS canonical,
            {by_class('number')} AS by_class, {by_class('number', True)} AS by_class_strict,
            {by_length('number')} AS by_length,
            CASE length(number) WHEN 9 THEN '2250' || number WHEN 10 THEN '225' || number
                 ELSE number END AS with_country,
            CASE WHEN instr(number, '225') BETWEEN 1 AND 5 OR length(number) <= 10
                 THEN {c.format('number')} ELSE number END AS if_local,
            CASE WHEN left(number, 5) NOT LIKE '%225%' THEN 'EXT' ELSE number END AS foreign_marked
            FROM (SELECT c_custkey, unnest([{number('c_custkey', '')}, {number('c_custkey', '7')},
              {number('c_custkey', '07')}, {number('c_custkey', '225')},
              {number('c_custkey', '22505')}, {number('c_custkey', '0033', 9)},
              {number('c_custkey', '')} || 'x', {LOCAL}, substr({number('c_custkey', '')}, 5, 4),
              NULL]) AS number FROM customer)""",
        "label_functions": f"""SELECT p_partkey,
            CASE p_size % 6 WHEN 1 THEN 'PREPAID' WHEN 2 THEN 'POSTPAID' WHEN 3 THEN 'HYBRID'
                 ELSE 'OTHERS' END AS subscriber,
            CASE p_size % 13 WHEN 1 THEN 'DATA' WHEN 2 THEN 'VOIX' WHEN 4 THEN 'SMS'
                 WHEN 10 THEN 'SVA' ELSE 'UNKNOWN' END AS service,
            CASE p_size % 6 WHEN 1 THEN 'FIX' WHEN 2 THEN 'MOBILE' WHEN 3 THEN 'INTERNET'
                 WHEN 4 THEN 'MOBILE/BANKING' ELSE 'UNKNOWN' END AS universe,
            {value_band('((p_retailprice - 900) * 40)')} AS band,
            {ratio_band('(p_retailprice - 900)', '(p_size % 10 * 100.0)')} AS ratio,
            {tariff(f"upper({profile_name('p_partkey')})", 'upper(p_type)')} AS tariff,
            CASE WHEN p_size % 7 = 4 OR p_retailprice > 1000 THEN '4G'
                 WHEN p_size % 7 IN (1, 2) THEN '2G' WHEN p_size % 7 = 3 THEN '3G'
                 WHEN p_size % 7 IN (0, 6) THEN 'INCONNU' END AS terminal,
            {r('p_retailprice / 1024')} AS mb,
            CASE WHEN p_retailprice > 1000 THEN 1 ELSE 0 END AS positive,
            CAST(p_size % 4 = 0 AND FALSE AS INTEGER) AS benefit_data,
            CAST(p_size % 4 = 0 AS INTEGER) AS benefit_mix,
            CAST(p_size % 4 <> 0 AND p_size % 6 = 0 AS INTEGER) AS benefit_appel_sms,
            CAST(p_size % 4 <> 0 AND p_size % 6 <> 0 AS INTEGER) AS benefit_others
            FROM part""",
        "day_range_filter": f"""SELECT o_orderstatus, count(*) AS n_orders,
            {r('sum(o_totalprice)')} AS total FROM orders
            WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-05' AND DATE '1997-02-28'
            GROUP BY o_orderstatus""",
        "transaction_filters": """SELECT transaction_tag,
            count(*) FILTER (transaction_status = 'TS' AND rollbacked IS NULL) AS n_completed,
            count(*) FILTER (transaction_tag <> 'A' AND length(sender_user_id) NOT IN (3, 4))
              AS n_not_cancelled,
            count(*) FILTER (service_charge_amount <> 0) AS n_non_zero,
            count(*) FILTER (sender_category_code = 'SUBS' AND receiver_category_code = 'SUBS')
              AS n_subscribers,
            count(*) FILTER (strftime(transaction_date_time, '%Y%m') BETWEEN '199603' AND '199809')
              AS n_key_range,
            count(*) FILTER (receiver_category_code NOT LIKE '%SH_P%'
              AND receiver_category_code NOT LIKE '%CAPAY') AS n_not_like,
            count(*) FILTER (commission_oca > 0) AS n_paid
            FROM wallet_tx GROUP BY transaction_tag""",
        "open_records": """SELECT partenaires, vas_id, offer_name, count(*) AS n_open
            FROM partners WHERE end_date = DATE '9999-12-31' GROUP BY ALL""",
        "category_service_filter": f"""SELECT category, service, universe, count(*) AS n_records,
            CAST(sum(duration) AS BIGINT) AS duration, {r('sum(conso_mb)')} AS conso
            FROM categorised GROUP BY category, service, universe""",
        "optional_filters": """SELECT service, categorie, re_id, count(*) AS n_records FROM records
            WHERE categorie LIKE '%INTER%' AND re_id = 'AO' AND universe = 'MOBILE'
            GROUP BY service, categorie, re_id""",
        "dim_left_join": f"""SELECT lv_label AS type_transaction, count(*) AS n_rows,
            {r('sum(raw_amount)')} AS total
            FROM channel_tx LEFT JOIN code_list ON lv_code = kind GROUP BY lv_label""",
        "dim_inner_chain": """SELECT re_id, categorie, service, count(*) AS n_records
            FROM records GROUP BY re_id, categorie, service""",
        "cohort_semi": f"""SELECT {c.format('sender_msisdn')} AS msisdn, count(*) AS n_sent,
            {r('sum(transaction_amount)')} AS total_sent FROM wallet_tx
            WHERE {c.format('sender_msisdn')} {IN_COHORT} GROUP BY 1""",
        "cohort_outer_complete": f"""SELECT phone AS msisdn, n_sent, total_sent FROM cohort
            LEFT JOIN (SELECT {c.format('sender_msisdn')} AS msisdn, count(*) AS n_sent,
              {r('sum(transaction_amount)')} AS total_sent FROM wallet_tx GROUP BY 1)
            ON msisdn = phone""",
        "two_sided_rows": f"""SELECT is_send, tag, category_code, other_category_code,
            count(*) AS n_rows, {r('sum(pre_balance)')} AS pre_balance,
            {r('sum(service_charge)')} AS service_charge, min(msisdn) AS first_msisdn
            FROM parties GROUP BY is_send, tag, category_code, other_category_code""",
        "contact_rows": f"""SELECT nd, msisdn, count(*) AS n_contacts FROM (
              SELECT DISTINCT numero AS nd, msisdn FROM (
                SELECT numero, {by_class('contact')} AS msisdn FROM fixed_lines
                UNION ALL SELECT numero, {by_class('second_contact')} FROM fixed_lines)
              WHERE msisdn IS NOT NULL) GROUP BY nd, msisdn""",
        "edge_aggregate": f"""SELECT tag, src, dst, nbr_transactions,
            {r('total_transaction')} AS total_transaction, {r('total_charge')} AS total_charge
            FROM tagged_edges""",
        "vertex_list": """SELECT DISTINCT id FROM (SELECT src AS id FROM edge_rows
            UNION ALL SELECT dst FROM edge_rows)""",
        "graph_in_out_profile": in_out("tagged_edges", "total_transaction"),
        "graph_degrees": """SELECT id, coalesce(i, 0) AS in_degree, coalesce(o, 0) AS out_degree
            FROM (SELECT dst AS id, count(*) AS i FROM tagged_edges GROUP BY dst)
            FULL JOIN (SELECT src AS id, count(*) AS o FROM tagged_edges GROUP BY src) USING (id)""",
        "graph_triangles": """SELECT id, coalesce(n, 0) AS n_triangles FROM (
              SELECT DISTINCT id FROM (SELECT src AS id FROM edge_rows
              UNION ALL SELECT dst FROM edge_rows)) LEFT JOIN triangle_counts USING (id)""",
        "graph_indicators": f"""SELECT '22507' || right(id, 8) AS msisdn, * EXCLUDE (id, n),
            coalesce(n, 0) AS n_triangles FROM ({in_out('graph_edges', 'total')})
            LEFT JOIN (SELECT id, count(*) AS n FROM graph_corners GROUP BY id) USING (id)
            WHERE '22507' || right(id, 8) {IN_COHORT}""",
        "peer_in_out_profile": peers(),
        "telecom_sms": peer_stats("SMS", "count(service)", "nbr_exch_sms"),
        "history_telecom_sms": peer_stats(
            "SMS", "count(service)", "nbr_exch_sms", "period_start, period_end, category",
            f"""(SELECT *, {day('s')} AS period_start, {day('s + 6')} AS period_end FROM categorised
                JOIN (SELECT CAST(DATE '1998-06-08' - 7 * CAST(i AS INTEGER) AS DATE) AS s
                      FROM range(0, 59) t(i)) ON start_time >= s AND start_time < s + 7)""",
        ),
        "history_telecom_data": f"""SELECT {day('s')} AS period_start, {day('s + 6')} AS period_end,
            category, msisdn, count(bytes) AS n_exch_data,
            CAST(sum(bytes) AS BIGINT) AS bytes_sum, {described('bytes')},
            {described('conso_mb', sums=True)} FROM categorised
            JOIN (SELECT CAST(DATE '1998-06-08' - 7 * CAST(i AS INTEGER) AS DATE) AS s
                  FROM range(0, 59) t(i)) ON start_time >= s AND start_time < s + 7
            WHERE service = 'DATA' AND universe = 'MOBILE' AND msisdn {IN_COHORT}
            GROUP BY s, category, msisdn""",
        "overlapping_edges": f"""SELECT {day('s - 21')} AS period_start, {day('s + 6')} AS period_end,
            l_returnflag AS transaction_tag,
            '22507' || right({number('o_custkey', '07')}, 8) AS src,
            '22507' || right({number('l_partkey', '07')}, 8) AS dst,
            count(l_extendedprice) AS nbr_transactions,
            {r('sum(l_extendedprice)')} AS total_transaction,
            count(l_extendedprice * l_tax) AS nbr_service_charge,
            {r('sum(l_extendedprice * l_tax)')} AS total_service_charge
            FROM order_lines JOIN (SELECT CAST(DATE '1998-06-08' - 7 * CAST(i AS INTEGER) AS DATE) AS s
              FROM range(0, 26) t(i)) ON o_orderdate >= s - 21 AND o_orderdate < s + 7
            WHERE NOT (l_linestatus = 'O' AND l_discount = 0) AND l_linenumber <> 7
            GROUP BY s, l_returnflag, o_custkey, l_partkey""",
        "telecom_voix": peer_stats("VOIX", "sum(duration)", "total_duration_voix"),
        "telecom_data": f"""SELECT category, msisdn, count(bytes) AS n_exch_data,
            CAST(sum(bytes) AS BIGINT) AS bytes_sum, {described('bytes')},
            {described('conso_mb', sums=True)} FROM categorised
            WHERE service = 'DATA' AND universe = 'MOBILE' AND msisdn {IN_COHORT}
            GROUP BY category, msisdn""",
        **{
            f"telecom_{name}": f"""SELECT category, msisdn, count(*) AS nbr_exch_{name}
            FROM categorised WHERE service = '{name.upper()}' AND universe = 'MOBILE'
              AND msisdn {IN_COHORT} GROUP BY category, msisdn"""
            for name in ("sva", "ims", "unknown")
        },
        "weeks_calendar": per_period(
            f"""SELECT o_totalprice, CAST({MONDAY} + 6 - isodow_shift - 7 * i - 6 AS DATE) AS s,
                   CAST({MONDAY} + 6 - isodow_shift - 7 * i AS DATE) AS e
                FROM (SELECT *, CASE WHEN isodow(o_orderdate) = 7 THEN 0 ELSE 7 END AS isodow_shift
                      FROM orders), (SELECT unnest([0, 1, 2]) AS i)
                UNION ALL
                SELECT o_totalprice, {MONDAY} + 7 + 7 * CAST(i AS INTEGER),
                       {MONDAY} + 13 + 7 * CAST(i AS INTEGER)
                FROM orders, (SELECT unnest([0, 1, 2, 3]) AS i)
                WHERE {MONDAY} + 7 + 7 * CAST(i AS INTEGER) <= CAST(o_orderdate AS DATE) + 20"""
        ),
        "forward_weeks_calendar": per_period(
            """SELECT o_totalprice, CAST(o_orderdate AS DATE) + 7 * CAST(i AS INTEGER) AS s,
                  CAST(o_orderdate AS DATE) + 7 * CAST(i AS INTEGER) + 6 AS e
               FROM orders, (SELECT unnest([0, 1]) AS i)"""
        ),
        "previous_week": per_period(
            f"SELECT o_totalprice, {MONDAY} - 7 AS s, {MONDAY} - 1 AS e FROM orders"
        ),
        "months_calendar": f"""SELECT month_id, count(*) AS n_orders, {r('sum(o_totalprice)')} AS total
            FROM (SELECT o_totalprice, strftime(m, '%Y%m') AS month_id FROM (
                SELECT o_orderdate, o_totalprice,
                       date_trunc('month', o_orderdate) + to_months(CAST(i AS INTEGER)) AS m
                FROM orders, (SELECT unnest([0, 1, 2]) AS i))
              WHERE m < CAST(o_orderdate AS DATE) + 45
              UNION ALL
              SELECT o_totalprice,
                     strftime(date_trunc('month', o_orderdate) - to_months(CAST(i AS INTEGER)), '%Y%m')
              FROM orders, (SELECT unnest([0, 1]) AS i))
            GROUP BY month_id""",
        "month_ranges": per_period(
            """SELECT o_totalprice, m AS s, last_day(CAST(m AS DATE)) AS e FROM (
                 SELECT o_totalprice,
                        date_trunc('month', o_orderdate) - to_months(CAST(i AS INTEGER)) AS m
                 FROM orders, (SELECT unnest([0, 1, 2]) AS i))"""
        ),
        "days_calendar": f"""SELECT {day('d')} AS day, count(*) AS n_orders,
            {r('sum(o_totalprice)')} AS total FROM (
              SELECT o_totalprice, CAST(o_orderdate AS DATE) - 1 AS d FROM orders
              UNION ALL SELECT o_totalprice, CAST(o_orderdate AS DATE) - 2 FROM orders
              UNION ALL SELECT o_totalprice, CAST(o_orderdate AS DATE) - 2 FROM orders
              UNION ALL SELECT o_totalprice, CAST(o_orderdate AS DATE)
                + CAST((9 - isodow(o_orderdate)) % 7 + 1 AS INTEGER) FROM orders)
            GROUP BY d""",
        "backfill_weekly": f"""SELECT {day('s')} AS period_start, {day('s + 6')} AS period_end,
            o_orderpriority, count(o_totalprice) AS n_orders, {described('o_totalprice')}
            FROM orders JOIN (SELECT CAST(DATE '2001-07-30' - 7 * CAST(i AS INTEGER) AS DATE) AS s
              FROM range(0, 345) t(i))
            ON o_orderdate >= s AND o_orderdate < s + 7
            GROUP BY s, o_orderpriority""",
        "late_day_profile": f"""SELECT {day('s')} AS period_start, {day('s + 6')} AS period_end,
            o_orderpriority, count(o_totalprice) AS n_o_totalprice, {described('o_totalprice')}
            FROM orders JOIN (SELECT CAST(DATE '1998-03-30' - 7 * CAST(i AS INTEGER) AS DATE) AS s
              FROM range(0, 13) t(i))
            ON o_orderdate >= s AND o_orderdate < s + 7
            GROUP BY s, o_orderpriority""",
        "usage_measures": f"""SELECT msisdn, {r('mnt_transactions')} AS mnt_transactions,
            {r('mnt_transactions_my')} AS mnt_transactions_my,
            {r('mnt_transactions_max')} AS mnt_transactions_max,
            {r('mnt_transactions_min')} AS mnt_transactions_min,
            service_cash, service_irt, service_p2p, service_voc, service_abon, service_frais,
            service_top_up, service FROM ({measures_sql()})""",
        "segment_centroid": segments_sql(),
        "segment_kmeans": f"""SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_not_nearest,
            CAST(0 AS BIGINT) AS n_unnamed FROM ({features_sql()}) WHERE msisdn {IN_COHORT}""",
    }
    sql["file_published"] = sql["file_partitioned_csv"]
    sql["cohort_sifted"] = sql["cohort_semi"]
    sql["graph_triangles_salted"] = sql["graph_triangles"]
    return {
        name: text if text.startswith("WITH") else with_tables(text) for name, text in sql.items()
    }


__all__ = ["TABLES", "statements"]
