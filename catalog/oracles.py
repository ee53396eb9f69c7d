"""SQL that states each registered query on its own terms: one CTE per window, global windows."""

from __future__ import annotations

from catalog.inputs import RULES
from tidemark.plans.campaign import FAMILIES


def _r(x: str, places: int) -> str:
    return f"(round_even(({x}) * 1e{places}, 0) / 1e{places})"


# --- derived inputs --------------------------------------------------------------------------

LINES = "lines AS (SELECT l.*, o.o_custkey AS customer_id FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"

NOTIFICATIONS = (
    LINES
    + """, notifications AS (
    SELECT customer_id,
        CASE l_returnflag WHEN 'N' THEN 'shown' WHEN 'R' THEN 'open' ELSE 'lost' END AS event_type,
        CAST(l_shipdate AS DATE) AS event_date, l_linestatus AS site,
        CASE WHEN l_linenumber = 7 THEN 'RECEIPT' ELSE 'CAMPAIGN' END AS path, 'wallet' AS business,
        CASE WHEN l_quantity < 3 THEN 'A_BLOCKED_1' WHEN l_quantity < 8 THEN 'B_CG' ELSE 'B_' || l_linenumber END AS batch_id,
        CASE WHEN l_discount < 0.02::DOUBLE THEN 'SPRING-SALE-A' WHEN l_discount < 0.04::DOUBLE THEN 'APP-PROMO'
             WHEN l_discount < 0.06::DOUBLE THEN 'PROMO-END' ELSE 'OTHER' END AS campaign_id
    FROM lines)"""
)

ACTIVITY = """activity AS (
    SELECT customer_id, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INT) AS month_id, l_linestatus AS site,
        floor(l_extendedprice) AS price, round_even(l_tax * 100, 0) AS tax, round_even(l_discount * 100, 0) AS discount,
        CAST(l_linenumber AS BIGINT) AS lines, CAST(l_quantity AS BIGINT) AS units,
        CAST(nullif(l_linenumber, 3) AS BIGINT) AS odd_lines
    FROM lines)"""

CARDS = (
    LINES
    + """, cards AS (
    SELECT customer_id, CAST(l_shipdate AS DATE) AS since, CASE WHEN l_quantity > 1 THEN l_partkey END AS card_id,
        CASE l_returnflag WHEN 'A' THEN [l_extendedprice] WHEN 'N' THEN [l_extendedprice, l_extendedprice / 2]
             ELSE [] END AS limits
    FROM lines),
limits AS (SELECT customer_id, since, card_id, unnest(limits) AS amount FROM cards)"""
)

DEVICES = """devices AS (
    SELECT c_custkey AS customer_id, c_mktsegment AS marketplace,
        CASE WHEN c_acctbal < -500 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status,
        CASE WHEN c_nationkey = 24 THEN 'NO' ELSE 'YES' END AS active,
        CASE WHEN c_nationkey < 10 THEN 'ios' WHEN c_nationkey < 20 THEN 'android' ELSE 'web' END AS platform,
        CASE WHEN c_acctbal BETWEEN 0 AND 500 THEN '  ' WHEN c_acctbal BETWEEN 501 AND 900 THEN NULL ELSE c_name END AS token
    FROM customer),
active AS (
    SELECT DISTINCT customer_id FROM devices
    WHERE marketplace IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') AND status = 'ACTIVE' AND active = 'YES'
      AND platform IN ('ios', 'android') AND token IS NOT NULL AND trim(token) <> '')"""

CONSENTS = """consents AS (
    SELECT o_custkey AS customer_id,
        CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'IN' WHEN left(o_orderpriority, 1) = '5' THEN 'OUT'
             ELSE 'OTHER' END AS consent_type,
        o_orderstatus AS consent_status, o_orderdate AS status_ts
    FROM orders)"""

EMPLOYEES = """employees AS (
    SELECT DISTINCT s_suppkey AS customer_id FROM supplier WHERE s_acctbal > 0 AND NOT s_nationkey < 5)"""

SEGMENTS = """segments AS (
    SELECT customer_id, segment AS "CLUSTER" FROM (
        SELECT o_custkey AS customer_id, o_orderpriority AS segment,
            row_number() OVER (PARTITION BY o_custkey
                ORDER BY year(o_orderdate) * 100 + month(o_orderdate) DESC NULLS LAST, o_orderpriority NULLS LAST) AS n
        FROM orders) WHERE n = 1)"""


def _consent_flags(first: str, last: str) -> str:
    return f"""{CONSENTS}, flag_in AS (
    SELECT customer_id, CASE WHEN CAST(status_ts AS DATE) BETWEEN DATE '{first}' AND DATE '{last}' THEN 'S' ELSE 'N' END AS flag_in_month
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY status_ts DESC) AS n FROM consents
          WHERE consent_type = 'IN' AND consent_status IN ('F', 'O') AND status_ts < DATE '{last}') WHERE n = 1),
data_out AS (SELECT DISTINCT customer_id FROM consents WHERE consent_type = 'OUT')"""


def _balances(*windows: tuple[str, str, str]) -> str:
    return ",\n".join(
        f"""saldo{s} AS (SELECT o_custkey AS customer_id, max(o_totalprice) AS "SALDO_EM_CONTA{s}" FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{a}' AND DATE '{z}' GROUP BY 1)"""
        for s, a, z in windows
    )


W = (("30", "1998-07-01", "1998-07-31"), ("60", "1998-06-01", "1998-06-30"), ("90", "1998-05-01", "1998-05-31"))
W_NEXT = (("30", "1998-08-01", "1998-08-31"), ("60", "1998-07-01", "1998-07-31"), ("90", "1998-06-01", "1998-06-30"))

_PUSH = """CAST(sum(CASE WHEN event_type = 'shown' THEN 1 ELSE 0 END) AS BIGINT) AS "SHOWNS_{s}",
    CAST(sum(CASE WHEN event_type = 'open' THEN 1 ELSE 0 END) AS BIGINT) AS "OPENS_{s}"
    FROM notifications
    WHERE site = 'O' AND path = 'CAMPAIGN' AND business = 'wallet' AND event_type IN ('open', 'shown')
      AND batch_id NOT LIKE '%BLOCKED%'"""


def _push(windows=W) -> str:
    """Campaign to date and one table per month; the oldest month leaves out one more pattern."""
    parts = [
        f"""push_OPF AS (SELECT customer_id, {_PUSH.format(s="OPF")}
      AND event_date < DATE '{windows[0][2]}' AND (campaign_id LIKE '%SALE%' OR campaign_id LIKE '%PROMO') GROUP BY 1)"""
    ]
    for s, a, z in windows:
        more = " AND batch_id NOT LIKE '%CG'" if s == "90" else ""
        parts.append(
            f"""push{s} AS (SELECT customer_id, {_PUSH.format(s=s)}
      AND event_date BETWEEN DATE '{a}' AND DATE '{z}'{more} GROUP BY 1)"""
        )
    return NOTIFICATIONS + ",\n" + ",\n".join(parts)


def _outer_chain(names: list[str]) -> str:
    return names[0] + "".join(f"\nFULL JOIN {n} USING (customer_id)" for n in names[1:])


def _activity_months() -> str:
    out = []
    for s, month in (("30", 199807), ("60", 199806), ("90", 199805)):
        sums = [f'CAST(sum({" + ".join(RULES.counts[f])}) AS BIGINT) AS "TPN_{f}{s}"' for f in FAMILIES]
        sums += [f'sum({" + ".join(RULES.amounts[f])}) AS "TPV_{f}{s}"' for f in FAMILIES]
        out.append(
            f"mau{s} AS (SELECT customer_id, {', '.join(sums)} FROM activity WHERE site = 'O' AND month_id = {month} GROUP BY 1)"
        )
    return ",\n".join(out)


LIFECYCLE = """lifecycle AS (
    SELECT customer_id, stage, category FROM (
        SELECT o_custkey AS customer_id, o_orderstatus AS stage, o_orderpriority AS category,
            row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders) WHERE n = 1)"""
LOYALTY = """loyalty AS (
    SELECT customer_id, CAST(round(level) AS BIGINT) AS level FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY level_from DESC, level) AS n FROM (
            SELECT o_custkey AS customer_id, floor(o_totalprice / 50000) + 0.5::DOUBLE AS level, o_orderdate AS level_from
            FROM orders)) WHERE n = 1)"""
CARD_HOLDERS = "card_holders AS (SELECT DISTINCT c_custkey AS customer_id FROM customer WHERE c_acctbal > 5000)"

TARGET = """target AS (
    SELECT customer_id, CAST(CASE WHEN count(*) <= 10 THEN count(*) ELSE 10 END AS BIGINT) AS target
    FROM (SELECT customer_id, card_id, max(amount) AS top FROM limits WHERE card_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


def _audience(month_windows, first, last) -> str:
    return f"""WITH {DEVICES}, {EMPLOYEES}, {SEGMENTS}, {_push(month_windows)}, {_consent_flags(first, last)},
pub AS (
    SELECT a.customer_id FROM active a
    LEFT JOIN push30 p USING (customer_id) LEFT JOIN segments s USING (customer_id)
    LEFT JOIN employees e ON e.customer_id = a.customer_id LEFT JOIN flag_in f ON f.customer_id = a.customer_id
    WHERE e.customer_id IS NULL AND p."SHOWNS_30" IS NOT NULL AND s."CLUSTER" <> '1-URGENT'
      AND (f.flag_in_month IS NULL OR f.flag_in_month = 'S'))"""


def _features(where: str) -> str:
    families = [f'"TPN_{f}{s}"' for s in ("30", "60", "90") for f in FAMILIES]
    families += [f'"TPV_{f}{s}"' for s in ("30", "60", "90") for f in FAMILIES]
    pushes = [f'"{k}_{s}"' for s in ("OPF", "30", "60", "90") for k in ("SHOWNS", "OPENS")]
    joined = "".join(
        f"\nLEFT JOIN {t} ON {t}.customer_id = a.customer_id"
        for t in (
            "data_out push_OPF push30 push60 push90 saldo30 saldo60 saldo90 segments employees lifecycle flag_in "
            "mau30 mau60 mau90 card_holders loyalty"
        ).split()
    )
    return f"""WITH {DEVICES}, {EMPLOYEES}, {SEGMENTS}, {_push()}, {ACTIVITY}, {_activity_months()},
{_consent_flags("1998-07-01", "1998-07-31")}, {_balances(*W)}, {LIFECYCLE}, {LOYALTY}, {CARD_HOLDERS}
SELECT a.customer_id, "CLUSTER", stage AS "CICLO_DE_VIDA", category AS "PRINCIPALIDADE", level AS "LOYALTY_LVL",
    CASE WHEN data_out.customer_id IS NULL THEN 'N' ELSE 'S' END AS "FLAG_DATA_OUT",
    CASE WHEN card_holders.customer_id IS NULL THEN 'N' ELSE 'S' END AS "FLAG_CARTAO_CREDITO",
    "SALDO_EM_CONTA30", "SALDO_EM_CONTA60", "SALDO_EM_CONTA90", {", ".join(families)}, {", ".join(pushes)}
FROM active a{joined}
WHERE employees.customer_id IS NULL AND "CLUSTER" <> '1-URGENT' {where}"""


SCORED = """scored AS (
    SELECT o_orderkey AS id, o_custkey AS customer_id, 1.0::DOUBLE - o_totalprice / (o_totalprice + 200000.0::DOUBLE) AS p0,
        o_totalprice / (o_totalprice + 200000.0::DOUBLE) AS p1,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target,
        CAST(left(o_orderpriority, 1) AS DOUBLE) AS level, o_totalprice AS price
    FROM orders)"""

SCORED_DOCS = """scored AS (
    SELECT d.doc_id AS id, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1000.0::DOUBLE) AS p1, quality AS target
    FROM documents d JOIN labels USING (doc_id))"""

PAIRS = """pairs AS (
    SELECT o_orderkey AS id, o_totalprice AS y, CAST(g.units AS DOUBLE) * 2000.0::DOUBLE AS pred
    FROM orders JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS units FROM lineitem GROUP BY 1) g
      ON g.l_orderkey = o_orderkey)"""

MODEL_ROWS = """rows AS (
    SELECT o_orderkey AS id, o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS price,
        CAST(month(o_orderdate) AS DOUBLE) AS month, CAST(dayofweek(o_orderdate) + 1 AS DOUBLE) AS weekday,
        CASE WHEN o_totalprice > 250000 AND o_orderstatus <> 'P' THEN 1
             WHEN month(o_orderdate) = 12 AND CAST('0x' || left(md5(o_orderkey || ':noise'), 13) AS BIGINT) > 2251799813685248 THEN 1
             ELSE 0 END AS target
    FROM orders)"""

REGISTRY = """registry AS (
    SELECT o_orderpriority AS "MODEL_NAME", CAST(date_trunc('month', o_orderdate) AS DATE) AS "SAFRA",
        strftime(max(o_orderdate), '%Y%m%d%H%M%S') AS "DT_TRAIN",
        CAST(floor(100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*)) AS INT) AS "METRIC"
    FROM orders GROUP BY 1, 2)"""

RUN_COLUMNS = """DATE '2024-02-01' AS "SAFRA", '20240201000000' AS "DT_EXEC", '20240101000000' AS "DT_TRAIN\""""


def _bin(order: str, q: int, source: str) -> str:
    """Equal-frequency bin from a global rank."""
    return f"""ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) AS r, count(*) OVER () AS n FROM {source}),
binned AS (SELECT *, greatest(1, ((r - 1) * {q} + n - 2) // (n - 1)) AS bin FROM ranked)"""


def _lift(order: str) -> str:
    rate = "CAST({0} AS DOUBLE) / ({1})".format
    avg = rate("g", "g + b")
    return f"""WITH {SCORED}, {_bin(order, 10, "scored")},
cells AS (SELECT bin AS scr_grp, count(*) FILTER (target = 0) AS neg, count(*) FILTER (target = 1) AS pos FROM binned GROUP BY 1),
sums AS (SELECT *, sum(pos) OVER (ORDER BY scr_grp) AS cp, sum(neg) OVER (ORDER BY scr_grp) AS cn,
    sum(pos) OVER () AS g, sum(neg) OVER () AS b FROM cells),
rates AS (SELECT *, {_r(rate("pos", "pos + neg"), 2)} AS resp_rate, {_r(rate("cp", "cp + cn"), 2)} AS cmltv_resp_rate,
    {_r("CAST(cp AS DOUBLE) / g * 100", 1)} AS cmltv_p_perc, {_r("CAST(cn AS DOUBLE) / b * 100", 1)} AS cmltv_n_perc,
    scr_grp / 10.0::DOUBLE * 100 AS cmltv_rand_p_perc FROM sums),
lift AS (SELECT CAST(scr_grp AS BIGINT) AS scr_grp, neg AS "Negatives", pos AS "Positives", resp_rate,
    {_r(f"resp_rate / ({avg})", 2)} AS lift, cmltv_p_perc, cmltv_n_perc, cmltv_rand_p_perc, cmltv_resp_rate,
    {_r(f"cmltv_resp_rate / ({avg})", 2)} AS cmltv_lift, {_r("cmltv_p_perc - cmltv_rand_p_perc", 2)} AS "KS",
    {_r("cmltv_p_perc - cmltv_n_perc", 1)} AS ks_distance FROM rates)"""


def _roc(source: str, score: str) -> str:
    return f"""WITH {source},
groups AS (SELECT {score} AS s, count(*) FILTER (target = 1) AS p, count(*) FILTER (target <> 1) AS n FROM scored GROUP BY 1),
steps AS (SELECT s, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS tot_p, sum(n) OVER () AS tot_n,
    lead(p) OVER w AS next_p, lead(n) OVER w AS next_n, row_number() OVER w AS i FROM groups WINDOW w AS (ORDER BY s DESC)),
points AS (SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, TRUE AS kept
    UNION ALL SELECT s, CAST(fp AS DOUBLE) / tot_n, CAST(tp AS DOUBLE) / tot_p,
        i = 1 OR next_p IS NULL OR next_p <> p OR next_n <> n FROM steps)"""


def _hash(key: str, seed) -> str:
    return f"CAST('0x' || left(md5({key} || ':{seed}'), 13) AS BIGINT)"


def _edge(x: str, edges, base: int = 0) -> str:
    cases = " ".join(f"WHEN {x} > {a} AND {x} <= {z} THEN {i + base}" for i, (a, z) in enumerate(zip(edges, edges[1:])))
    return f"CAST(CASE {cases} END AS BIGINT)"


PRICE_EDGES = [0, 50000, 100000, 200000, 300000, 400000, 1000000]
CONFUSION = f"""WITH {PAIRS}, cells AS (SELECT {_edge("pred", PRICE_EDGES)} AS pred_grp, {_edge("y", PRICE_EDGES)} AS target_grp, count(*) AS cnt
    FROM pairs GROUP BY 1, 2), kept AS (SELECT * FROM cells WHERE pred_grp IS NOT NULL AND target_grp IS NOT NULL)"""


def _encode(col: str, out: str, weight: str) -> str:
    return f"""{out} AS (SELECT {col} AS c, {weight} * mean + (1 - {weight}) * prior AS v FROM (
    SELECT {col}, count(*) AS n, avg(target) AS mean, (SELECT avg(target) FROM rows) AS prior FROM rows GROUP BY 1))"""


def _best_f1(cuts: str, label: str) -> str:
    return f"""SELECT {_r("max(f1)", 9)} AS best_f1, '{label}' AS cuts FROM (
    SELECT coalesce(2.0::DOUBLE * count(*) FILTER (target = 1 AND p1 >= cut)
        / nullif(count(*) FILTER (p1 >= cut) + count(*) FILTER (target = 1), 0), 0) AS f1
    FROM scored, ({cuts}) GROUP BY cut)"""


def _selected(champions: str, case: str) -> str:
    known = "\"MODEL_NAME\" = '1-URGENT' AND \"SAFRA\" <= DATE '1998-08-01'"
    return f"""SELECT coalesce(c."SAFRA", l."SAFRA") AS "SAFRA", coalesce(c."DT_TRAIN", l."DT_TRAIN") AS "DT_TRAIN",
    CASE WHEN c."SAFRA" IS NOT NULL THEN 'champion' ELSE 'latest' END AS source, '{case}' AS "case"
FROM (SELECT "SAFRA", "DT_TRAIN" FROM registry WHERE {known} ORDER BY "SAFRA" DESC, "DT_TRAIN" DESC LIMIT 1) l
FULL JOIN (SELECT "SAFRA", "DT_TRAIN" FROM registry WHERE {known} AND {champions}
    ORDER BY "METRIC" DESC, "SAFRA" DESC, "DT_TRAIN" DESC LIMIT 1) c ON TRUE"""


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    o["scan_parquet"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity > 45"
    o["sql_source"] = """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders
        WHERE o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1998-08-01' AND o_orderstatus <> 'P' GROUP BY 1"""
    o["snapshot_roundtrip"] = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'O')"
    o["append_roundtrip"] = "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders"

    o["audience_active"] = f"WITH {DEVICES} SELECT customer_id FROM active"
    o["pattern_filter"] = f"""WITH {NOTIFICATIONS} SELECT batch_id, campaign_id, count(*) AS n FROM notifications
        WHERE batch_id NOT LIKE '%BLOCKED%' AND batch_id NOT LIKE '%CG'
          AND (campaign_id LIKE '%SALE%' OR campaign_id LIKE '%PROMO') GROUP BY 1, 2"""
    o["month_flag"] = """SELECT o_orderkey,
        CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-07-01' AND DATE '1998-07-31' THEN 'S' ELSE 'N' END AS flag FROM orders"""
    o["presence_flag"] = """SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
        AND o_orderpriority = '1-URGENT') THEN 'S' ELSE 'N' END AS has_urgent FROM customer"""
    o["drop_columns"] = "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part"
    o["measure_families"] = f"""WITH {LINES}, {ACTIVITY} SELECT customer_id, month_id, sum(price + tax + discount) AS tpv,
        CAST(sum(units + odd_lines) AS BIGINT) AS tpn FROM activity GROUP BY 1, 2"""
    o["period_shift"] = """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 3 MONTH, '%Y%m') AS three_months_before,
        strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d') AS two_weeks_after FROM orders"""
    o["edge_bin"] = f"""SELECT {_edge("l_quantity", [1, 10, 20, 30, 45])} AS bin, count(*) AS n FROM lineitem GROUP BY 1"""

    o["star_join"] = f"""WITH {SEGMENTS}, {_balances(*W)}, {_consent_flags("1998-07-01", "1998-07-31")},
        flags AS (SELECT customer_id, max(f.flag_in_month) AS flag_in_month, bool_or(d.customer_id IS NOT NULL) AS has_data_out
            FROM (SELECT DISTINCT customer_id FROM consents) LEFT JOIN flag_in f USING (customer_id)
            LEFT JOIN data_out d USING (customer_id) WHERE f.customer_id IS NOT NULL OR d.customer_id IS NOT NULL GROUP BY 1)
        SELECT c_custkey AS customer_id, "CLUSTER", "SALDO_EM_CONTA30", "SALDO_EM_CONTA60", "SALDO_EM_CONTA90", flag_in_month,
            has_data_out, CASE WHEN c_acctbal > 5000 THEN 'active' ELSE 'closed' END AS card_status
        FROM customer LEFT JOIN segments s ON s.customer_id = c_custkey LEFT JOIN saldo30 a ON a.customer_id = c_custkey
        LEFT JOIN saldo60 b ON b.customer_id = c_custkey LEFT JOIN saldo90 d ON d.customer_id = c_custkey
        LEFT JOIN flags f ON f.customer_id = c_custkey"""
    o["exclude_members"] = f"""WITH {EMPLOYEES} SELECT c_custkey AS customer_id, c_name FROM customer
        LEFT JOIN employees e ON e.customer_id = c_custkey WHERE e.customer_id IS NULL"""
    o["require_activity"] = f"""WITH {LINES}, {ACTIVITY} SELECT c_custkey AS customer_id, c_name FROM customer
        WHERE c_custkey IN (SELECT customer_id FROM activity WHERE month_id = 199807)"""
    o["unnest_limits"] = f"WITH {CARDS} SELECT customer_id, count(*) AS limits, {_r('sum(amount)', 2)} AS amount FROM limits GROUP BY 1"
    o["training_set"] = f"""WITH {DEVICES}, {_balances(*W[:2])}, {CARDS}, big AS (
            SELECT customer_id, least(count(DISTINCT card_id), 10) AS target FROM limits WHERE since < DATE '1998-08-01' GROUP BY 1)
        SELECT customer_id, "SALDO_EM_CONTA30", "SALDO_EM_CONTA60", CAST(coalesce(target, 0) AS BIGINT) AS target
        FROM active LEFT JOIN saldo30 USING (customer_id) LEFT JOIN saldo60 USING (customer_id) LEFT JOIN big USING (customer_id)"""
    o["scoring_set"] = f"""WITH {DEVICES}, {_balances(*W_NEXT)} SELECT customer_id, "SALDO_EM_CONTA30", "SALDO_EM_CONTA60", "SALDO_EM_CONTA90"
        FROM active LEFT JOIN saldo30 USING (customer_id) LEFT JOIN saldo60 USING (customer_id) LEFT JOIN saldo90 USING (customer_id)"""
    cards_only = CARDS.removeprefix(LINES + ", ")
    o["evaluation_set"] = f"""{_audience(W_NEXT, "1998-08-01", "1998-08-31")}, {cards_only}, {TARGET}
        SELECT customer_id, coalesce(target, 0) AS target FROM pub LEFT JOIN target USING (customer_id)"""
    o["join_scores_labels"] = """SELECT doc_id, quality AS target, n_chars AS "SCORES" FROM labels JOIN documents USING (doc_id)"""

    o["event_counts"] = f"""WITH {NOTIFICATIONS} SELECT customer_id, CAST(count(*) FILTER (event_type = 'shown') AS BIGINT) AS shown,
        CAST(count(*) FILTER (event_type = 'open') AS BIGINT) AS opened FROM notifications WHERE event_type IN ('shown', 'open') GROUP BY 1"""
    o["first_event_dates"] = f"""WITH {NOTIFICATIONS} SELECT customer_id, min(event_date) FILTER (event_type = 'shown') AS first_shown,
        min(event_date) FILTER (event_type = 'open') AS first_open FROM notifications GROUP BY 1"""
    o["monthly_max_balance"] = f"""WITH {_balances(*W)} SELECT customer_id, "SALDO_EM_CONTA30", "SALDO_EM_CONTA60", "SALDO_EM_CONTA90"
        FROM {_outer_chain(["saldo30", "saldo60", "saldo90"])}"""
    o["trailing_features"] = f"WITH {_push()} SELECT * FROM {_outer_chain(['push_OPF', 'push30', 'push60', 'push90'])}"
    weeks = [("_w1", "2024-01-22"), ("_w2", "2024-01-15"), ("_w3", "2024-01-08")]
    week_tables = ", ".join(
        f"""t{s} AS (SELECT user_id, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views{s},
            CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks{s},
            min(CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END) AS first_click{s}, max(value) AS top_value{s}
            FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{a}' AND DATE '{a}' + 6 GROUP BY 1)"""
        for s, a in weeks
    )
    o["trailing_weeks"] = f"WITH {week_tables} SELECT * FROM t_w1 FULL JOIN t_w2 USING (user_id) FULL JOIN t_w3 USING (user_id)"
    o["history_to_date"] = f"""WITH {NOTIFICATIONS} SELECT customer_id, CAST(count(*) FILTER (event_type = 'shown') AS BIGINT) AS shown,
        min(event_date) FILTER (event_type = 'open') AS first_open FROM notifications WHERE event_date < DATE '1998-07-31' GROUP BY 1"""
    o["distinct_members"] = f"WITH {CONSENTS} SELECT DISTINCT customer_id FROM consents WHERE consent_type = 'OUT'"
    o["capped_count_target"] = f"WITH {CARDS}, {TARGET} SELECT * FROM target"
    o["latest_per_key"] = """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC NULLS LAST, o_orderkey NULLS LAST) AS n FROM orders) WHERE n = 1"""
    o["latest_scores"] = """WITH h AS (SELECT o_orderpriority AS "MODEL_NAME", o_orderkey AS customer_id,
            CAST(floor(o_totalprice) AS BIGINT) AS "SCORES_0", CAST(date_trunc('month', o_orderdate) AS DATE) AS "SAFRA",
            strftime(o_orderdate, '%Y%m%d%H%M%S') AS "DT_EXEC", '19980101000000' AS "DT_TRAIN" FROM orders),
        mine AS (SELECT * FROM h WHERE "MODEL_NAME" = '1-URGENT' AND "SAFRA" = DATE '1998-07-01')
        SELECT * FROM mine WHERE "DT_EXEC" = (SELECT max("DT_EXEC") FROM mine)"""
    o["dataset_profile"] = f"""WITH {MODEL_ROWS}, f AS (SELECT count(*) AS n, avg(CASE WHEN target = 1 THEN 1.0 ELSE 0.0 END) AS share FROM rows)
        SELECT 'train' AS stage, 'rows' AS key, CAST(n AS VARCHAR) AS value FROM f UNION ALL SELECT 'train', 'columns', '6'
        UNION ALL SELECT 'train', 'class_proportion', printf('%.6f', share) FROM f
        UNION ALL SELECT 'train', 'var_names', 'id,priority,status,price,month,weekday'"""
    push_columns = ["customer_id"] + [f"{k}_{s}" for s in ("OPF", "30", "60", "90") for k in ("SHOWNS", "OPENS")]
    o["null_profile"] = f"WITH {_push()}, t AS (SELECT * FROM {_outer_chain(['push_OPF', 'push30', 'push60', 'push90'])}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (\"{c}\" IS NULL) AS nulls FROM t" for c in push_columns
    )

    o["campaign_audience"] = _audience(W, "1998-07-01", "1998-07-31") + " SELECT customer_id FROM pub"
    o["customer_features"] = _features(
        "AND push30.customer_id IS NOT NULL AND (flag_in_month IS NULL OR flag_in_month = 'S')"
    )
    o["customer_scoring_base"] = _features("")

    o["rank_timestamps"] = "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rank FROM orders"
    o["rank_decimal_ties"] = """WITH t AS (SELECT o_orderkey, CAST(floor(o_totalprice / 100000) AS DECIMAL(12,2)) AS step FROM orders)
        SELECT *, row_number() OVER (ORDER BY step, o_orderkey) AS rank FROM t"""
    o["rank_string_key"] = """WITH t AS (SELECT 'order-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS key, o_orderpriority FROM orders)
        SELECT *, row_number() OVER (ORDER BY o_orderpriority, key) AS rank FROM t"""
    o["global_rank"] = f"WITH {SCORED} SELECT id, level, row_number() OVER (ORDER BY level, id) AS rank FROM scored"
    o["decile"] = f"WITH {SCORED}, {_bin('p0, id', 10, 'scored')} SELECT id, p0, bin AS decile FROM binned"
    o["decile_ties"] = f"WITH {SCORED}, {_bin('level, id', 7, 'scored')} SELECT id, level, bin FROM binned"
    o["percentile_bins"] = f"WITH {SCORED}, {_bin('p0, id', 100, 'scored')} SELECT id, p0, bin FROM binned"
    o["rank_edge_bins"] = f"""WITH {SCORED}, ranked AS (SELECT id, p1, row_number() OVER (ORDER BY p1, id) AS r FROM scored)
        SELECT id, p1, {_edge("r", list(range(11)))} AS bin FROM ranked"""
    o["sample_n"] = f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash('o_orderkey', 7)}, o_orderkey LIMIT 1000"
    o["train_test_split"] = f"""SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY {_hash("o_orderkey", 42)}, o_orderkey)
        <= ceil(count(*) OVER () * 0.2::DOUBLE) AS is_test FROM orders"""
    o["undersample"] = f"""WITH {MODEL_ROWS}, numbered AS (SELECT id, status, target,
            row_number() OVER (PARTITION BY target ORDER BY {_hash("id", 42)}, id) AS r FROM rows)
        SELECT id, status, target FROM numbered WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM rows GROUP BY target))"""
    o["sorted_series"] = f"""WITH {PAIRS} SELECT row_number() OVER (ORDER BY y, id) AS position, {_r("ln(y + 1e-5)", 6)} AS log_actual,
        {_r("ln(pred + 1e-5)", 6)} AS log_predicted FROM pairs"""

    o["impute_categorical"] = f"WITH {DEVICES} SELECT customer_id, coalesce(token, 'missing') AS token, coalesce(platform, 'missing') AS platform FROM devices"
    o["impute_numeric"] = f"""WITH t AS (SELECT l_orderkey, CASE WHEN l_discount = 0 THEN 0 WHEN l_tax > 0 THEN l_discount ELSE 0 END AS x,
            coalesce(nullif(l_linenumber, 3), 0) AS n FROM lineitem)
        SELECT l_orderkey, {_r("sum(x)", 4)} AS x, max(x) AS top, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1"""
    o["target_encode"] = f"""WITH {MODEL_ROWS}, {_encode("priority", "pe", "(n / (n + 20.0::DOUBLE))")},
        {_encode("status", "se", "(n / (n + 20.0::DOUBLE))")}, {_encode("priority", "ps", "(1 / (1 + exp(-(n - 3000.0::DOUBLE) / 500.0::DOUBLE)))")}
        SELECT id, priority, status, target, {_r("pe.v", 6)} AS priority_enc, {_r("se.v", 6)} AS status_enc, {_r("ps.v", 6)} AS priority_sig
        FROM rows JOIN pe ON pe.c = priority JOIN se ON se.c = status JOIN ps ON ps.c = priority"""
    o["minmax_scale"] = f"""WITH b AS (SELECT min(p_size) AS a, max(p_size) AS z, min(p_retailprice) AS pa, max(p_retailprice) AS pz FROM part)
        SELECT p_partkey, {_r("(p_size - a)::DOUBLE / (z - a)", 9)} AS size, {_r("(p_retailprice - pa) / (pz - pa)", 9)} AS price, 0.0::DOUBLE AS flat FROM part, b"""
    o["variance_filter"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {_r(f'var_pop({c})', 6)} AS variance FROM lineitem HAVING var_pop({c}) > 0.00065"
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")
    )
    nullable = MODEL_ROWS.replace("o_orderstatus AS status", "CASE WHEN o_orderstatus = 'P' THEN 'missing' ELSE o_orderstatus END AS status")
    o["prep_features"] = f"""WITH {nullable}, {_encode("priority", "pe", "(n / (n + 20.0::DOUBLE))")}, {_encode("status", "se", "(n / (n + 20.0::DOUBLE))")}
        SELECT id, {_r("pe.v", 6)} AS priority_enc, {_r("se.v", 6)} AS status_enc, {_r("price", 6)} AS price, month, weekday
        FROM rows JOIN pe ON pe.c = priority JOIN se ON se.c = status"""

    o["score_table_class"] = f"""WITH {SCORED}, {_bin("p0, id", 10, "scored")} SELECT 'propensity' AS "MODEL_NAME", id, bin AS "DECIL",
        CAST(trunc(p0 * 10000) AS BIGINT) AS "SCORES_0", CAST(trunc(p1 * 10000) AS BIGINT) AS "SCORES_1", {RUN_COLUMNS} FROM binned"""
    o["score_table_regr"] = f"""WITH {PAIRS} SELECT 'potential' AS "MODEL_NAME", id, {_edge("pred", PRICE_EDGES, 1)} AS "DECIL",
        CAST(pred AS DECIMAL(18,2)) AS "SCORES", {RUN_COLUMNS} FROM pairs"""
    o["score_table_regr_rank"] = f"""WITH {PAIRS}, ranked AS (SELECT *, row_number() OVER (ORDER BY pred, id) AS r FROM pairs)
        SELECT 'potential' AS "MODEL_NAME", id, {_edge("r", list(range(11)), 1)} AS "DECIL", CAST(pred AS DECIMAL(18,2)) AS "SCORES", {RUN_COLUMNS} FROM ranked"""
    o["binned_calibration"] = f"""WITH {SCORED}, {_bin("p1, id", 20, "scored")},
        probs AS (SELECT bin, sum(target)::DOUBLE / count(target) AS prob FROM binned GROUP BY 1)
        SELECT id, {_r("p1", 6)} AS p1, target, bin - 1 AS bin, {_r("prob", 6)} AS calibrated,
            CAST(CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM binned JOIN probs USING (bin)"""
    o["binned_calibration_edges"] = f"""WITH {SCORED}, {_bin("p1, id", 20, "scored")},
        probs AS (SELECT bin, sum(target)::DOUBLE / count(target) AS prob FROM binned GROUP BY 1),
        ends AS (SELECT p1 AS end_p1, id AS end_id FROM binned JOIN (SELECT unnest(range(1, 20)) AS k) ON r = 1 + k * (n - 1) // 20),
        new AS (SELECT id, p1 * 0.75::DOUBLE AS p1 FROM scored),
        placed AS (SELECT id, 1 + count(end_id) AS bin FROM new LEFT JOIN ends ON p1 > end_p1 OR (p1 = end_p1 AND id > end_id) GROUP BY id)
        SELECT id, CAST(bin - 1 AS BIGINT) AS bin, {_r("prob", 6)} AS calibrated, CAST(CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction
        FROM placed JOIN probs USING (bin)"""
    o["optimal_threshold"] = f"""{_roc(SCORED_DOCS, "p1")} SELECT {_r("threshold", 9)} AS threshold, {_r("fpr", 9)} AS fpr, {_r("tpr", 9)} AS tpr,
        {_r("sqrt(tpr * (1 - fpr))", 9)} AS gmean FROM points WHERE kept ORDER BY sqrt(tpr * (1 - fpr)) DESC, points.threshold DESC LIMIT 1"""
    o["apply_threshold"] = f"""WITH {SCORED} SELECT target, CAST(CASE WHEN p1 >= 0.55::DOUBLE THEN 1 ELSE 0 END AS BIGINT) AS prediction,
        count(*) AS n FROM scored GROUP BY 1, 2"""
    o["classification_report"] = f"""WITH {SCORED}, t AS (SELECT target AS y, CASE WHEN p1 >= 0.55::DOUBLE THEN 1 ELSE 0 END AS p FROM scored),
        per AS (SELECT c, count(*) FILTER (y = c AND p = c)::DOUBLE AS tp, count(*) FILTER (p = c)::DOUBLE AS said,
            count(*) FILTER (y = c) AS support FROM t, (VALUES (0), (1)) v(c) GROUP BY 1),
        m AS (SELECT *, tp / said AS precision, tp / support AS recall, 2 * tp / (said + support) AS f1_score FROM per)
        SELECT CAST(c AS VARCHAR) AS label, {_r("precision", 9)} AS precision, {_r("recall", 9)} AS recall, {_r("f1_score", 9)} AS f1_score, support FROM m
        UNION ALL SELECT 'accuracy', {_r("sum(tp) / sum(support)", 9)}, {_r("sum(tp) / sum(support)", 9)}, {_r("sum(tp) / sum(support)", 9)}, CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'macro avg', {_r("avg(precision)", 9)}, {_r("avg(recall)", 9)}, {_r("avg(f1_score)", 9)}, CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'weighted avg', {_r("sum(precision * support) / sum(support)", 9)}, {_r("sum(recall * support) / sum(support)", 9)},
            {_r("sum(f1_score * support) / sum(support)", 9)}, CAST(sum(support) AS BIGINT) FROM m"""
    o["roc_points"] = f"""{_roc(SCORED_DOCS, "p1")} SELECT {_r("threshold", 9)} AS threshold, {_r("fpr", 9)} AS fpr, {_r("tpr", 9)} AS tpr FROM points WHERE kept"""
    o["roc_points_all"] = f"""{_roc(SCORED, "level")} SELECT threshold, {_r("fpr", 9)} AS fpr, {_r("tpr", 9)} AS tpr FROM points"""
    o["roc_auc"] = f"""WITH {SCORED}, g AS (SELECT p1, count(*) FILTER (target = 1) AS p, count(*) FILTER (target <> 1) AS n FROM scored GROUP BY 1),
        s AS (SELECT p, n, sum(n) OVER (ORDER BY p1) - n AS nb FROM g)
        SELECT {_r("CAST(sum(p * (2 * nb + n)) AS DOUBLE) / (2.0::DOUBLE * sum(p) * sum(n))", 10)} AS roc_auc FROM s"""
    cal = " ".join(f"WHEN p1 <= {i} * 0.1::DOUBLE THEN {i - 1}" for i in range(1, 10))
    o["calibration_curve"] = f"""WITH {SCORED} SELECT CAST(CASE {cal} ELSE 9 END AS BIGINT) AS bin, {_r("avg(p1)", 6)} AS prob_pred,
        {_r("avg(target)", 6)} AS prob_true, count(*) AS rows FROM scored GROUP BY 1"""
    logs = """SELECT pow(10.0::DOUBLE, log10(a + 1e-5::DOUBLE) + i * ((log10(z + 1e-5::DOUBLE) - log10(a + 1e-5::DOUBLE)) / 99)) AS cut
        FROM (SELECT min(p1) AS a, max(p1) AS z FROM scored), range(100) r(i)"""
    linear = "SELECT a + i * ((z - a) / 50) AS cut FROM (SELECT min(p1) AS a, max(p1) AS z FROM scored), range(50) r(i)"
    o["best_f1"] = f"WITH {SCORED} {_best_f1(logs, 'log')} UNION ALL {_best_f1(linear, 'linear')}"
    o["lift_table"] = _lift("p0, id") + " SELECT * FROM lift"
    o["lift_ties"] = _lift("level, id") + " SELECT * FROM lift"
    dec = "CAST(printf('%.6e', {0}) AS DECIMAL(38,18))".format
    o["eval_table_class"] = f"""{_lift("p0, id")} SELECT 'propensity' AS "MODEL_NAME", scr_grp AS "DECIL", "Negatives" + "Positives" AS "PUBLICO",
        "Positives" AS "CONVERSAO", {dec("resp_rate")} AS "RESP_RATE", {dec("lift")} AS "LIFT", {dec("cmltv_p_perc")} AS "CONVERSAO_ACC",
        {dec('CAST("Positives" AS DOUBLE) / sum("Positives") OVER () * 100')} AS "CONVERSAO_PERC", {dec('"KS"')} AS "KS", {RUN_COLUMNS} FROM lift"""
    o["confusion_bins"] = f"{CONFUSION} SELECT * FROM kept"
    edges = [0, 100, 1000, 5000, 9000]
    o["confusion_bins_rank"] = f"""WITH {PAIRS}, r AS (SELECT row_number() OVER (ORDER BY pred, id) AS rp, row_number() OVER (ORDER BY y, id) AS ry FROM pairs),
        c AS (SELECT {_edge("rp", edges)} AS pred_grp, {_edge("ry", edges)} AS target_grp FROM r)
        SELECT pred_grp, target_grp, count(*) AS cnt FROM c WHERE pred_grp IS NOT NULL AND target_grp IS NOT NULL GROUP BY 1, 2"""
    o["confusion_pivot"] = f"{CONFUSION} SELECT pred_grp, " + ", ".join(
        f"CAST(sum(cnt) FILTER (target_grp = {i}) AS BIGINT) AS target_{i}" for i in range(6)
    ) + " FROM kept GROUP BY 1"
    o["eval_table_regr"] = f"""{CONFUSION} SELECT 'potential' AS "MODEL_NAME", pred_grp AS "PRED_BIN", target_grp AS "TARGET_BIN", cnt AS "QTDE", {RUN_COLUMNS} FROM kept"""
    o["regression_metrics"] = f"""WITH {PAIRS} SELECT {_r("1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*))", 6)} AS r2, {_r("avg(abs(y - pred))", 6)} AS mae,
        {_r("avg((y - pred) * (y - pred)) / 1e6", 6)} AS mse, {_r("corr(y, pred)", 6)} AS pearson FROM pairs"""
    o["spearman"] = f"""WITH {PAIRS}, r AS (SELECT rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0::DOUBLE AS ry,
        rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0::DOUBLE AS rp FROM pairs)
        SELECT {_r("corr(ry, rp)", 8)} AS spearman FROM r"""
    o["score_histogram"] = f"""WITH {SCORED}, b AS (SELECT min(p1) AS a, (max(p1) - min(p1)) / 20 AS w FROM scored),
        c AS (SELECT CAST(target AS BIGINT) AS label, CAST(least(floor((p1 - a) / w), 19) AS BIGINT) AS bin, count(*) AS rows FROM scored, b GROUP BY 1, 2)
        SELECT label, bin, {_r("a + bin * w", 6)} AS bin_start, rows, {_r("CAST(rows AS DOUBLE) / sum(rows) OVER (PARTITION BY label) / w", 6)} AS density FROM c, b"""

    o["best_model"] = f"""WITH {REGISTRY} SELECT "SAFRA", "DT_TRAIN", "METRIC" AS "BEST_METRIC" FROM registry
        WHERE "MODEL_NAME" = '1-URGENT' AND "SAFRA" <= DATE '1998-08-01' ORDER BY "METRIC" DESC, "SAFRA" DESC, "DT_TRAIN" DESC LIMIT 1"""
    o["latest_trained"] = f"""WITH {REGISTRY} SELECT "SAFRA", "DT_TRAIN" FROM registry
        WHERE "MODEL_NAME" = '1-URGENT' AND "SAFRA" <= DATE '1998-08-01' ORDER BY "SAFRA" DESC, "DT_TRAIN" DESC LIMIT 1"""
    o["champion_decision"] = f"""WITH {REGISTRY}, best AS (SELECT "MODEL_NAME", max("METRIC") AS "BEST_METRIC" FROM registry
            WHERE "SAFRA" < DATE '1998-01-01' AND "MODEL_NAME" <> '5-LOW' GROUP BY 1)
        SELECT r.*, "BEST_METRIC", "BEST_METRIC" IS NULL OR "METRIC" + 15 >= "BEST_METRIC" AS accepted FROM registry r LEFT JOIN best USING ("MODEL_NAME")
        WHERE "SAFRA" >= DATE '1998-01-01'"""
    o["select_model"] = f"WITH {REGISTRY} " + " UNION ALL ".join(
        f"({_selected(cond, case)})"
        for cond, case in (('"METRIC" >= 40', "in_use"), ("FALSE", "not_in_use"), ('"METRIC" > 100', "none_yet"))
    )

    draw = "base || ':' || i"
    for name, minority in (("smote_points", "label = 3"), ("smote_points_many", "label < 4")):
        o[name] = f"""WITH m AS (SELECT vec_id AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings WHERE {minority}),
        d AS (SELECT a.id AS base, b.id AS neighbour, a.v AS av, b.v AS bv,
            row_number() OVER (PARTITION BY a.id ORDER BY list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(a.v, b.v)]), b.id) AS n
            FROM m a JOIN m b ON a.id <> b.id),
        s AS (SELECT (SELECT count(*) FROM m) AS small, (SELECT count(*) FROM embeddings) - 2 * (SELECT count(*) FROM m) AS missing),
        b AS (SELECT id AS base, missing // small + CASE WHEN row_number() OVER (ORDER BY {_hash("id", "42:base")}, id) <= missing % small THEN 1 ELSE 0 END AS copies FROM m, s),
        c AS (SELECT base, unnest(range(1, copies + 1)) AS i FROM b),
        p AS (SELECT base, {_hash("(" + draw + ")", "42:neighbour")} % least(5, (SELECT small FROM s) - 1) + 1 AS n,
            {_hash("(" + draw + ")", "42:gap")} / 4503599627370496.0::DOUBLE AS gap FROM c)
        SELECT base, neighbour, {_r("gap", 9)} AS gap, {_r("list_sum([q[1] + gap * (q[2] - q[1]) FOR q IN list_zip(av, bv)])", 5)} AS total
        FROM p JOIN d USING (base, n)"""
    o["smote_classes"] = """WITH c AS (SELECT count(*) FILTER (label = 3) AS few, count(*) FILTER (label IS NULL OR label <> 3) AS many FROM embeddings)
        SELECT 1 AS target, FALSE AS synthetic, few AS n FROM c UNION ALL SELECT 0, FALSE, many FROM c UNION ALL SELECT 1, TRUE, many - few FROM c"""
    noise = _hash("o_orderkey", "noise")
    o["fit_facts"] = f"""SELECT count(*) AS n_rows, count(*) AS n_sum_one, TRUE AS better_than_chance,
        CAST(count(*) FILTER ((o_totalprice > 250000 AND o_orderstatus <> 'P') OR (month(o_orderdate) = 12 AND {noise} > 2251799813685248)) AS BIGINT) AS n_positive FROM orders"""
    o["append_runs"] = "SELECT 'run-' || o_orderstatus AS append_run, o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"
    names = "l_quantity l_extendedprice l_discount l_tax l_partkey".split()
    values = ", ".join(f"max(CAST({c} AS DOUBLE)) AS {c}" for c in names)
    sent = ", ".join(f"g{1 + i % 2}.{c} AS perm_{c}" for i, c in enumerate(names))
    o["permuted_columns"] = f"""WITH lines AS (SELECT l_orderkey * 10 + l_linenumber AS id, {values} FROM lineitem GROUP BY 1),
    r AS (SELECT *, row_number() OVER (ORDER BY {_hash("id", 11)}, id) - 1 AS r, count(*) OVER () AS n FROM lines)
    SELECT r.id, {", ".join("r." + c for c in names)}, {sent} FROM r
    JOIN r g1 ON g1.r = (r.r + r.n // 3) % r.n JOIN r g2 ON g2.r = (r.r + r.n * 2 // 3) % r.n"""
    o["search_facts"] = "SELECT CAST(6 AS BIGINT) AS n_first, CAST(3 AS BIGINT) AS n_last, CAST(1 AS BIGINT) AS n_best, TRUE AS best_is_least"
    o["saved_threshold_differences"] = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders"
    # The largest, over all lower ends, of the least mean of the levels from there to any upper end.
    o["isotonic_levels"] = f"""WITH g AS (
        SELECT l_quantity AS level, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::DOUBLE AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1
    ), c AS (SELECT *, sum(y) OVER (ORDER BY level) AS ys, sum(n) OVER (ORDER BY level) AS ns FROM g), least AS (
        SELECT t.level, a.level AS low, min((b.ys - a.ys + a.y) / (b.ns - a.ns + a.n)) AS mean
        FROM c t JOIN c a ON a.level <= t.level JOIN c b ON b.level >= t.level GROUP BY 1, 2
    ) SELECT level, {_r("max(mean)", 9)} AS value FROM least GROUP BY 1"""
    o["model_roundtrip_differences"] = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM orders"
    o["batch_score_deciles"] = """WITH r AS (SELECT row_number() OVER () AS r, count(*) OVER () AS n FROM orders)
        SELECT CAST(greatest(1, ((r - 1) * 10 + n - 2) // (n - 1)) AS BIGINT) AS "DECIL", count(*) AS n FROM r GROUP BY 1"""
    return o
