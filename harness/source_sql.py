"""SQL twins of the stand-in sources: named common table expressions."""

from __future__ import annotations

import re


def number(key: str, prefix: str = "22507", size: int = 8) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), {size}, '0')"


def profile_name(key: str) -> str:
    names = [
        "xCommunityx", "SPXD_BR_NOVA", "SP_D_OI_1", "mytest", "dauphin", "KIT_JEUNE",
        "bara", "neo plus second", "orangina", "other", "abc2007", "sp br_nova x",
    ]
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {key} % {len(names)} {cases} END"


LOCAL = (
    "'0' || CAST(c_nationkey % 10 AS VARCHAR) || lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0')"
)
LINE = (
    "CASE WHEN c_nationkey % 10 <= 3 THEN '22501' WHEN c_nationkey % 10 <= 6 THEN '22505'"
    f" ELSE '22507' END || {LOCAL}"
)
WRITTEN = (
    f"CASE c_custkey % 5 WHEN 0 THEN {LOCAL} WHEN 1 THEN '225' || {LOCAL}"
    f" WHEN 2 THEN {LINE} WHEN 3 THEN {LOCAL} || 'x' END"
)
MONTH_NUMBER = (
    f"CASE c_custkey % 4 WHEN 0 THEN {number('c_custkey', '225')}"
    f" WHEN 1 THEN {number('c_custkey', '')} ELSE {number('c_custkey')} END"
)
MONEY = "greatest(c_acctbal, 0)"

TABLES = {
    "cohort": f"SELECT DISTINCT {number('c_custkey')} AS phone FROM customer WHERE c_acctbal > 0",
    "line_cohort": f"SELECT DISTINCT {LINE} AS phone FROM customer WHERE c_acctbal > 0",
    "order_lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "wallet_tx": f"""
        SELECT {number('o_custkey', '07')} AS sender_msisdn,
               {number('l_suppkey', '22505')} AS receiver_msisdn,
               'S' || CAST(o_custkey AS VARCHAR) AS sender_user_id,
               'R' || CAST(l_suppkey AS VARCHAR) AS receiver_user_id,
               CASE WHEN o_orderstatus IN ('F', 'P') THEN 'TS' ELSE 'TF' END AS transaction_status,
               CASE WHEN l_linestatus = 'O' AND l_discount = 0 THEN 'Y' END AS rollbacked,
               'SUBS' AS sender_category_code,
               CASE WHEN l_linestatus = 'O' THEN 'SUBS'
                    WHEN l_suppkey % 10 = 0 THEN 'PDVCAPAY' ELSE 'SHOP' END AS receiver_category_code,
               CASE WHEN l_suppkey % 10 = 0 THEN 'CAPAY' ELSE 'OTHER' END AS receiver_domain_code,
               o_totalprice AS sender_pre_balance,
               o_totalprice - l_extendedprice AS sender_post_balance,
               l_quantity * 100 AS receiver_pre_balance,
               l_quantity * 100 + l_extendedprice AS receiver_post_balance,
               l_extendedprice AS transaction_amount,
               l_extendedprice * l_tax AS service_charge_amount,
               l_tax AS commission_oca,
               l_returnflag AS transaction_tag,
               o_orderdate AS transaction_date_time
        FROM order_lines""",
    "parties": """
        SELECT '22507' || right(sender_msisdn, 8) AS msisdn, 1 AS is_send,
               sender_user_id AS user_id, sender_pre_balance AS pre_balance,
               sender_post_balance AS post_balance, sender_category_code AS category_code,
               receiver_category_code AS other_category_code, transaction_amount AS amount,
               service_charge_amount AS service_charge, transaction_tag AS tag,
               transaction_date_time
        FROM wallet_tx WHERE transaction_status = 'TS' AND rollbacked IS NULL
        UNION ALL
        SELECT '22507' || right(receiver_msisdn, 8), 0, receiver_user_id, receiver_pre_balance,
               receiver_post_balance, receiver_category_code, sender_category_code,
               transaction_amount, service_charge_amount, transaction_tag, transaction_date_time
        FROM wallet_tx WHERE transaction_status = 'TS' AND rollbacked IS NULL""",
    "partners": f"""
        SELECT {number('s_suppkey', '22505')} AS msisdn,
               'BILL' || CAST(s_nationkey AS VARCHAR) AS partenaires,
               CASE WHEN s_acctbal < 0 THEN 'OTHER' ELSE 'FACTURES' END AS vas_id,
               CASE WHEN s_nationkey % 5 = 0 THEN 'Financier' ELSE 'Standard' END AS offer_name,
               CASE WHEN s_nationkey % 7 = 3 THEN DATE '2020-01-01'
                    ELSE DATE '9999-12-31' END AS end_date
        FROM supplier""",
    "credit_transfers": f"""
        SELECT {number('o_custkey', '07')} AS sender_msisdn,
               {number('l_suppkey', '22505')} AS receiver_msisdn,
               l_extendedprice AS transfer_value,
               CASE WHEN l_linenumber < 7 THEN l_linenumber END AS final_transfer_status_lv,
               o_orderdate AS transfer_date_time
        FROM order_lines""",
    "channel_tx": """
        SELECT ts AS transfer_date_time,
               CASE event_type WHEN 'click' THEN 2250700000000 WHEN 'view' THEN 1000000000
                    ELSE 700000000 END + user_id AS receiver_msisdn,
               event_type AS kind,
               CAST(CAST(value * 100 AS DECIMAL(30, 0)) AS DOUBLE) AS transfer_amount,
               CAST(CAST(value * 10 AS DECIMAL(30, 0)) AS DOUBLE) AS commission,
               value * 100 AS raw_amount,
               CASE WHEN event_type = 'signup' THEN '5' ELSE '200' END AS status
        FROM events""",
    "code_list": """
        SELECT DISTINCT event_type AS lv_code, upper(event_type) AS lv_label
        FROM events WHERE event_type <> 'error'""",
    "recharges": f"""
        SELECT '22507' || right({number('user_id', '07')}, 8) AS msisdn,
               value AS amount, value * 2 AS initial_loan, value / 2 AS already_paid_back,
               coalesce(CASE WHEN value <= 20 THEN value * 3 END, 0) AS remain_to_pay_back,
               CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 3
                    WHEN 0 THEN 5 WHEN 1 THEN 30 ELSE 7 END AS channel,
               CASE event_type WHEN 'error' THEN 'EMERGENCY CREDIT'
                    WHEN 'view' THEN 'EMERGENCY DATA' END AS tag,
               CASE user_id % 6 WHEN 1 THEN 'PREPAID' WHEN 2 THEN 'POSTPAID'
                    WHEN 3 THEN 'HYBRID' ELSE 'OTHERS' END AS subscriber_type
        FROM events""",
    "subscriptions": f"""
        SELECT '22507' || right({number('o_custkey', '07')}, 8) AS msisdn,
               left(o_orderpriority, 1) AS kind,
               CASE o_orderstatus WHEN 'F' THEN 'PREPAID' WHEN 'O' THEN 'POSTPAID'
                    ELSE 'OTHERS' END AS subscriber_type
        FROM orders""",
    "cdr": f"""
        SELECT {number('o_custkey', '07')} AS calling_nbr,
               CASE WHEN l_linenumber = 7 THEN {number('l_partkey', '0033', 9)}
                    ELSE {number('l_partkey')} END AS called_nbr,
               l_returnflag || l_linestatus AS re_id,
               CAST(l_quantity AS BIGINT) AS duration,
               CAST(round(l_discount * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS bytes,
               CASE l_linenumber WHEN 1 THEN 'DATA' WHEN 2 THEN 'VOIX' WHEN 3 THEN 'SMS'
                    WHEN 4 THEN 'SVA' WHEN 5 THEN 'IMS' WHEN 6 THEN 'UNKNOWN'
                    ELSE 'VOIX' END AS service,
               CASE WHEN l_tax = 0 THEN 'FIX' ELSE 'MOBILE' END AS universe,
               l_suppkey AS called_prefix_id,
               (CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice ELSE 0 END
                + CASE WHEN l_linenumber % 3 = 1 THEN l_tax * 100 ELSE 0 END
                + l_quantity) / 100 AS conso_mb, l_shipdate AS start_time
        FROM order_lines""",
    "events_known": """
        SELECT DISTINCT l_returnflag || l_linestatus AS re_id,
               CASE l_returnflag WHEN 'A' THEN 'CALL INTER' WHEN 'R' THEN 'ROAMING IN'
                    ELSE 'NATIONAL' END AS categorie
        FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus <> 'F'""",
    "records": """
        SELECT '22507' || right(calling_nbr, 8) AS src,
               CASE WHEN length(called_nbr) <= 10 OR left(called_nbr, 7) LIKE '%225%'
                    THEN '22507' || right(called_nbr, 8) ELSE called_nbr END AS dst,
               '22507' || right(calling_nbr, 8) AS msisdn,
               service, universe, cdr.re_id, categorie, duration, bytes, conso_mb, start_time
        FROM cdr JOIN supplier ON s_suppkey = called_prefix_id AND s_acctbal > 0
                 JOIN events_known ON cdr.re_id = events_known.re_id""",
    "categorised": """
        SELECT records.*, 'local' AS category FROM records
        UNION ALL SELECT records.*, 'inter' FROM records WHERE categorie LIKE '%INTER%'
        UNION ALL SELECT records.*, 'roaming' FROM records WHERE categorie LIKE '%ROAM%'""",
    "months": "SELECT unnest(['202401', '202402']) AS month_id",
    "value_datamart": f"""
        SELECT c_custkey, {MONTH_NUMBER} AS raw, month_id,
               upper({profile_name('c_custkey')}) AS profil,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'HYBRIDE' WHEN 'MACHINERY' THEN 'POSTPAID'
                    ELSE 'PREPAID' END AS kind,
               {MONEY} * 4 + CASE WHEN c_nationkey = 3 THEN {MONEY} * -4
                    ELSE c_nationkey * 500.0 END AS spend,
               {MONEY} * 10 AS data_kb, c_nationkey AS nation, {MONEY} AS money,
               CASE WHEN c_nationkey = 5 THEN 0 ELSE {MONEY} + c_nationkey * 400.0 END AS recharge,
               {MONEY} / 4 + c_nationkey * 10.0 AS via_wallet
        FROM customer, months""",
    "terminal_datamart": f"""
        SELECT {MONTH_NUMBER} AS raw, month_id,
               CASE WHEN c_custkey % 7 = 4 OR c_acctbal > 8000 THEN '4G'
                    WHEN c_custkey % 7 IN (1, 2) THEN '2G'
                    WHEN c_custkey % 7 = 3 THEN '3G'
                    WHEN c_custkey % 7 IN (0, 6) THEN 'INCONNU' END AS type_terminal
        FROM customer, months""",
    "fixed_lines": f"""
        SELECT c_mktsegment AS plan_tarifaire, CAST(c_nationkey AS VARCHAR) || 'M' AS debit,
               lower(c_mktsegment) AS categorie,
               CASE WHEN c_nationkey < 12 THEN 'HOME' ELSE 'OFFICE' END AS categorie_client,
               CASE WHEN c_acctbal > 5000 THEN 'ACTIVE' ELSE 'IDLE' END AS etat,
               {WRITTEN} AS contact,
               CASE c_nationkey % 3 WHEN 0 THEN {LINE} WHEN 1 THEN '225' || {LOCAL}
                    ELSE 'n/a' END AS second_contact,
               'CITY' || CAST(c_nationkey AS VARCHAR) AS ville, c_name AS numero,
               '2024010' || CAST(c_custkey % 3 + 1 AS VARCHAR) AS date_jour
        FROM customer""",
    "edge_rows": """
        SELECT o_custkey AS src, l_partkey AS dst, l_extendedprice AS amount,
               l_quantity AS charge, l_returnflag AS tag FROM order_lines""",
    "tagged_edges": """
        SELECT src, dst, tag, count(amount) AS nbr_transactions, sum(amount) AS total_transaction,
               sum(charge) AS total_charge
        FROM edge_rows GROUP BY src, dst, tag""",
    "ends": """
        SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b
        FROM edge_rows WHERE src <> dst""",
    "corners": """
        SELECT unnest([e.a, e.b, f.b]) AS id
        FROM ends e JOIN ends f ON e.b = f.a JOIN ends g ON g.a = e.a AND g.b = f.b""",
    "triangle_counts": "SELECT id, count(*) AS n FROM corners GROUP BY id",
    "graph_tx": f"""
        SELECT {number('o_custkey', '07')} AS src, {number('l_partkey', '07')} AS dst,
               l_returnflag AS tag, l_extendedprice AS amount
        FROM order_lines
        WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '2002-01-01'
          AND NOT (l_linestatus = 'O' AND l_discount = 0) AND l_linenumber <> 7""",
    "graph_edges": "SELECT src, dst, tag, sum(amount) AS total FROM graph_tx GROUP BY src, dst, tag",
    "graph_ends": """
        SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b
        FROM graph_edges WHERE src <> dst""",
    "graph_corners": """
        SELECT unnest([e.a, e.b, f.b]) AS id
        FROM graph_ends e JOIN graph_ends f ON e.b = f.a
             JOIN graph_ends g ON g.a = e.a AND g.b = f.b""",
}


def with_tables(select: str) -> str:
    """Prefix a SELECT with the common table expressions it uses."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed)
    return f"WITH {parts}\n{select}"
