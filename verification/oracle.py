"""The same results in plain SQL over the given tables, per query name."""

from __future__ import annotations

# Relations the queries are derived from. Each entry may use those before it.
_RELATIONS = {
    "lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS INTEGER) AS line_number,
               CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS line_count
        FROM lineitem""",
    "bronze_orders": """
        SELECT o_orderkey AS id, o_custkey AS userId, o_orderdate,
               CAST(round(o_totalprice * 100) AS BIGINT) AS total,
               CASE d.n WHEN 1 THEN o_orderstatus WHEN 2 THEN 'Y' WHEN 3 THEN 'X' ELSE 'Z' END AS status,
               d.f AS _source_file, d.t AS ingestion_timestamp
        FROM orders CROSS JOIN (VALUES
            (1, 'orders-0001.json', TIMESTAMP '2026-01-01 00:00:00'),
            (2, 'orders-0000.json', TIMESTAMP '2026-01-01 00:00:00'),
            (3, 'orders-0002.json', TIMESTAMP '2026-01-02 00:00:00'),
            (4, 'orders-0003.json', TIMESTAMP '2026-01-02 00:00:00')) AS d(n, f, t)
        WHERE d.n = 1 OR (d.n = 2 AND o_orderstatus = 'F') OR (d.n = 3 AND o_orderpriority = '1-URGENT')
           OR (d.n = 4 AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')""",
    "latest_order": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingestion_timestamp DESC, _source_file DESC) AS rn
                       FROM bronze_orders) WHERE rn = 1""",
    "customers": """
        SELECT sha256(CAST(c_custkey AS VARCHAR)) AS customer_sk, c_custkey AS customer_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' (renamed)' ELSE c_name END AS customer_name,
               lower(c_name) AS username, 'user' || c_custkey || '@example.com' AS email, 'avatar/' || c_custkey AS avatar,
               CASE WHEN c_acctbal < 0 THEN 'debtor' ELSE 'buyer' END AS role,
               '+' || c_nationkey || '-' || c_custkey AS phone, 'https://example.com/' || c_custkey AS website,
               'Street ' || c_custkey AS address_street, c_mktsegment AS address_suite, 'City ' || c_nationkey AS address_city,
               'Z' || c_custkey AS address_zipcode, c_acctbal AS address_lat, -c_acctbal AS address_lng,
               c_mktsegment || ' Inc' AS company_name, 'We do ' || lower(c_mktsegment) AS company_catch_phrase,
               lower(c_mktsegment) AS company_bs,
               CASE WHEN c_mktsegment = 'BUILDING' THEN TIMESTAMP '2026-01-02 00:00:00' ELSE TIMESTAMP '2026-01-01 00:00:00' END
                 AS ingestion_timestamp
        FROM customer""",
    "products": """
        SELECT sha256(CAST(p_partkey AS VARCHAR)) AS product_sk, p_partkey AS product_id, p_name AS title,
               p_type || ' ' || p_name AS description, p_brand AS category,
               CAST(round(p_retailprice * 100) AS BIGINT) + CASE WHEN p_type = 'ECONOMY' THEN 100 ELSE 0 END AS price,
               'img/' || p_partkey AS image, p_size / 2.0::DOUBLE AS rating_rate, CAST(p_size AS BIGINT) AS rating_count,
               CASE WHEN p_type = 'ECONOMY' THEN TIMESTAMP '2026-01-02 00:00:00' ELSE TIMESTAMP '2026-01-01 00:00:00' END
                 AS ingestion_timestamp
        FROM part""",
    "fact": """
        SELECT sha256(concat_ws('|', o.id, l.line_number)) AS order_sk, o.id AS order_id, l.line_number,
               c.customer_sk, o.userId AS customer_id, p.product_sk, l.product_id, l.quantity,
               CAST(o.o_orderdate AS TIMESTAMP) AS order_date, o.status, o.total AS order_total, o.ingestion_timestamp
        FROM latest_order o JOIN lines l ON l.order_id = o.id
        LEFT JOIN customers c ON c.customer_id = o.userId LEFT JOIN products p ON p.product_id = l.product_id""",
    "kpis": """
        SELECT order_id, max(customer_sk) AS customer_sk, max(customer_id) AS customer_id, min(order_date) AS order_date,
               max(status) AS status, max(order_total) AS order_total, count(DISTINCT line_number) AS line_count,
               CAST(sum(quantity) AS BIGINT) AS units_sold
        FROM fact GROUP BY order_id""",
    "merge_target": """
        SELECT o_orderkey AS business_key, o_custkey, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "merge_source": """
        SELECT o_orderkey AS business_key, o_custkey,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderstatus END AS status
        FROM orders WHERE o_orderpriority <> '2-HIGH'""",
    "merged": """
        SELECT coalesce(s.business_key, t.business_key) AS business_key, s.status AS new_status, t.status AS old_status,
               s.o_custkey AS new_custkey, t.o_custkey AS old_custkey,
               CASE WHEN s.business_key IS NULL THEN 'deleted' WHEN t.business_key IS NULL THEN 'new'
                    WHEN s.status IS DISTINCT FROM t.status OR s.o_custkey IS DISTINCT FROM t.o_custkey THEN 'changed'
                    ELSE 'unchanged' END AS change_type
        FROM merge_source s FULL JOIN merge_target t ON s.business_key = t.business_key""",
    "opportunities": """
        SELECT 'OPP-' || user_id AS opportunity_id, event_type AS stage_name, CAST(ts AS TIMESTAMP) AS ts, event_id FROM events""",
    "weekly": """
        SELECT opportunity_id, stage_name, ts FROM (
            SELECT *, row_number() OVER (PARTITION BY opportunity_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM opportunities) WHERE rn = 1""",
    "weekly_versions": """
        SELECT opportunity_id, stage_name, ts AS start_at, lead(ts) OVER (PARTITION BY opportunity_id ORDER BY ts) AS end_at FROM (
            SELECT *, lag(stage_name) OVER (PARTITION BY opportunity_id ORDER BY ts) AS previous FROM weekly)
        WHERE stage_name IS DISTINCT FROM previous""",
    "pulls": """
        SELECT o_orderkey AS run_id, o_orderstatus AS st, o_orderpriority AS pr,
               CAST((SELECT count(*) FROM lineitem s WHERE s.l_orderkey = o.o_orderkey) AS INTEGER) AS n
        FROM orders o""",
    "pulled": """
        SELECT *, CASE WHEN st = 'F' THEN 1 ELSE greatest(1, CAST(ceil(n / 2.0) AS INTEGER)) END AS pages_n FROM pulls""",
    "pulled_pages": """
        SELECT run_id, st, pr, n, pages_n, CAST(unnest(range(1, pages_n + 1)) AS INTEGER) AS page_no FROM pulled""",
    "config": """
        SELECT 'api-' || c_custkey AS api_id, c_name AS api_name,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'full' WHEN c_mktsegment <> 'FURNITURE' THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type,
               c_nationkey AS overlap, CASE WHEN c_mktsegment = 'MACHINERY' THEN TIMESTAMP '2024-01-01 00:00:00' END AS initial_value,
               CASE WHEN c_acctbal > 5000 THEN 'CURSOR' END AS paging, c_nationkey, c_acctbal
        FROM customer""",
    "points": """
        SELECT 'api-' || o_custkey AS api_id,
               CASE o_orderstatus WHEN 'O' THEN 'Cursor' WHEN 'F' THEN 'WATERMARK' ELSE 'watermark' END AS state_type,
               CASE o_orderstatus WHEN 'O' THEN 'cursor-' || o_orderkey ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS state_value,
               CAST(o_orderdate AS TIMESTAMP) AS recorded_at, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id
        FROM orders""",
    "latest_points": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY api_id ORDER BY recorded_at DESC, run_id DESC) AS rn FROM points) WHERE rn = 1""",
    "runs": """
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id, CAST(o_custkey AS VARCHAR) AS job_run_id, o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status, n,
               CAST(o_orderdate AS TIMESTAMP) + to_minutes(n) AS end_time
        FROM orders JOIN pulls ON pulls.run_id = o_orderkey""",
    "latest_runs": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_run_id ORDER BY end_time DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""",
}


def _with(*names: str, final: str) -> str:
    """Prefix ``final`` with the named relations and all they refer to."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        words = set(_RELATIONS[name].replace("(", " ").replace(")", " ").replace(",", " ").split())
        for other in _RELATIONS:
            if other != name and other in words and list(_RELATIONS).index(other) < list(_RELATIONS).index(name):
                add(other)
        needed.append(name)

    for name in names:
        add(name)
    parts = ", ".join(f"{n} AS ({_RELATIONS[n].strip()})" for n in needed)
    return f"WITH {parts} {final.strip()}"


def _report(rules: dict[str, str], source: str) -> str:
    rows = [
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed, count(*) AS total,"
        f" count(*) FILTER (WHERE NOT coalesce({p}, false)) = 0 AS passed FROM {source}"
        for name, p in rules.items()
    ]
    return " UNION ALL ".join(rows)


_LINE_RULES = {
    "order_present": "l_orderkey IS NOT NULL",
    "quantity_positive": "l_quantity > 0",
    "discount_small": "l_discount < 0.09",
    "returned_or_open": "l_returnflag IN ('A', 'R')",
}
_FACT_RULES = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_line_number": "line_number IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_product_id": "product_id IS NOT NULL",
    "valid_quantity": "quantity > 0",
}


def _checks(*rows: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, CAST({l} AS DECIMAL(38,2)) AS left_value, CAST({r} AS DECIMAL(38,2)) AS right_value,"
        f" CAST(({l}) - ({r}) AS DECIMAL(38,2)) AS difference, ({l}) = ({r}) AS passed"
        for n, l, r in rows
    )


def _history(key: str, tracked: str) -> str:
    return f"""
        SELECT {key}, {tracked}, event_id, start_at, lead(start_at) OVER (PARTITION BY {key} ORDER BY start_at, event_id) AS end_at
        FROM (SELECT {key}, {tracked}, event_id, ts AS start_at,
                     lag({tracked}) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS previous
              FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY {key}, ts ORDER BY event_id DESC, {tracked} DESC) = 1))
        WHERE {tracked} IS DISTINCT FROM previous"""


# States of a user by event: an error deletes, and equal neighbours are one version.
_FEED_VERSIONS = """
    SELECT user_id, event_type AS kind, value, start_at, end_at FROM (
        SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS end_at FROM (
            SELECT user_id, event_type, value, event_id, event_id AS start_at FROM events
            QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id)))
    WHERE event_type <> 'error'"""

_FEED_LAST = """
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"""

_BODY = "||chr(10)||".join(
    f"({part})"
    for part in [
        "'Job: ' || coalesce(CASE WHEN r.run_id IS NOT NULL THEN 'nightly_load' END, 'N/A')",
        "'Run ID: ' || c.c_custkey",
        "'Overall Status: ' || s1",
        "''",
        "'Ingestion'",
        "'---------'",
        "'API records read: ' || coalesce(CASE WHEN r.status = 'SUCCESS' THEN CAST(r.n AS VARCHAR) END, 'N/A')",
        "'Pages read: ' || coalesce(CASE WHEN r.status = 'SUCCESS' THEN '1' END, 'N/A')",
        "'Landing file: ' || coalesce(CASE WHEN r.status = 'SUCCESS' THEN 'orders/' || r.o_orderkey || '.json' END, 'N/A')",
        "'Landing file size (bytes): N/A'",
        "'Ingestion status: ' || s1",
        "''",
        "'Pipeline'",
        "'--------'",
        "'Bronze: ' || s2",
        "'Silver: ' || s2",
        "'Gold: ' || s2",
        "''",
        "'Data Quality'",
        "'-----------'",
        "'DQ status: ' || s3",
        "''",
        "'Reconciliation'",
        "'--------------'",
        "'Status: ' || s3",
        "''",
        "'Failure Diagnostics'",
        "'--------------------'",
        "'Failure stage: ' || coalesce(CASE WHEN r.status = 'FAILED' THEN 'LANDING' END, 'N/A')",
        "'Failure type: ' || coalesce(CASE WHEN r.status = 'FAILED' THEN 'HTTP_ERROR' END, 'N/A')",
        "'Retry count: N/A'",
        "'Total attempts: N/A'",
        "'Error message: N/A'",
    ]
)

ORACLE: dict[str, str] = {
    "latest_orders": _with("latest_order", "lines", final="""
        SELECT id, userId, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS date, status, total,
               CAST(coalesce((SELECT count(*) FROM lineitem s WHERE s.l_orderkey = id), 0) AS INTEGER) AS lines,
               _source_file, ingestion_timestamp
        FROM latest_order"""),
    "dim_customer": _with("customers", final="SELECT * FROM customers"),
    "dim_product": _with("products", final="SELECT * FROM products"),
    "fact_order": _with("fact", final="SELECT * FROM fact"),
    "gold_order_kpis": _with("kpis", final="SELECT * FROM kpis"),
    "gold_customer_sales": _with("kpis", final="""
        SELECT m.customer_sk, m.customer_id, c.customer_name, m.order_count, m.sales_amount, m.units_sold FROM (
            SELECT customer_sk, customer_id, count(DISTINCT order_id) AS order_count,
                   CAST(sum(order_total) AS BIGINT) AS sales_amount, CAST(sum(units_sold) AS BIGINT) AS units_sold
            FROM kpis GROUP BY 1, 2) m
        LEFT JOIN customers c ON c.customer_sk = m.customer_sk AND c.customer_id = m.customer_id"""),
    "gold_product_sales": _with("fact", final="""
        SELECT m.product_sk, m.product_id, p.title AS product_title, p.category, m.order_count, m.units_sold,
               m.first_order_date, m.last_order_date FROM (
            SELECT product_sk, product_id, count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS units_sold,
                   min(order_date) AS first_order_date, max(order_date) AS last_order_date
            FROM fact GROUP BY 1, 2) m
        LEFT JOIN products p ON p.product_sk = m.product_sk AND p.product_id = m.product_id"""),
    "latest_opportunities": """
        SELECT 'OPP-' || user_id AS opportunity_id, 'Deal ' || user_id AS name, CAST(value AS DECIMAL(18,2)) AS amount,
               event_type AS stage_name, CAST(ts AS DATE) AS close_date,
               '{"type":"Opportunity","url":"/o/' || user_id || '"}' AS source_attributes, CAST(ts AS TIMESTAMP) AS ingestion_timestamp
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "opportunity_scd2_view": f"""
        SELECT row_number() OVER (ORDER BY opportunity_id, effective_start_ts, effective_end_ts NULLS LAST) AS opportunity_sk, *,
               effective_end_ts IS NULL AS is_active
        FROM (SELECT 'OPP-' || user_id AS opportunity_id, event_type AS stage_name, CAST(start_at AS TIMESTAMP) AS effective_start_ts,
                     CAST(end_at AS TIMESTAMP) AS effective_end_ts FROM ({_history('user_id', 'event_type')}))""",
    "dimension_lookup": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name AS part_sk
        FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON p_partkey = l_partkey""",
    "dimension_lookup_salted": """
        SELECT l_orderkey, l_linenumber, l_returnflag, 'flag-' || f AS flag_sk FROM lineitem LEFT JOIN (
            SELECT DISTINCT o_orderstatus AS f FROM orders
            UNION ALL SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag <> 'R') ON f = l_returnflag""",
    "record_path_extract": _with("lines", "bronze_orders", final="""
        SELECT l.product_id AS "productId", l.quantity, b._source_file, 'orders' AS _api_id, b.ingestion_timestamp
        FROM bronze_orders b JOIN lines l ON l.order_id = b.id"""),
    "explode_outer_flatten": _with("lines", final="""
        SELECT o_orderkey AS order_id, coalesce(product_id, -1) AS product_id, coalesce(quantity, -1) AS quantity
        FROM orders LEFT JOIN lines ON order_id = o_orderkey"""),
    "explode_lines": _with("lines", final="SELECT order_id, product_id, quantity FROM lines"),
    "user_feed_flatten": _with("lines", final="""
        SELECT coalesce(product_id, -1) AS business_key, order_key, coalesce(quantity, -1) AS quantity FROM (
            SELECT product_id, o_orderkey AS order_key, quantity,
                   row_number() OVER (PARTITION BY product_id ORDER BY o_orderkey DESC, quantity DESC) AS rn
            FROM orders LEFT JOIN lines ON order_id = o_orderkey) WHERE rn = 1"""),
    "drop_duplicate_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "record_hash": """
        SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS record_hash
        FROM orders""",
    "iso_timestamp_text": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts_text FROM events""",
    "json_settings": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "sum_at_grain": """
        SELECT o_orderstatus, count(*) AS grain_rows, CAST(sum(c) AS BIGINT) AS total FROM (
            SELECT o_orderstatus, o_orderkey, max(CAST(round(o_totalprice * 100) AS BIGINT)) AS c
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1""",
    "fan_out_error": _with("fact", final="""
        SELECT (SELECT count(DISTINCT order_id) FROM fact) AS order_count,
               (SELECT CAST(sum(t) AS BIGINT) FROM (SELECT max(order_total) AS t FROM fact GROUP BY order_id)) AS order_grain_sales,
               CAST(sum(order_total) AS BIGINT) AS line_grain_sales, count(*) AS line_count FROM fact"""),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_report": _report(_LINE_RULES, "lineitem"),
    "dq_fact_order": _with("fact", final=_report(_FACT_RULES, "fact")),
    "dq_expect_in_plan": _with("fact", final="SELECT order_id, line_number, quantity FROM fact"),
    "dq_quarantine": """
        SELECT concat_ws(',', CASE WHEN l_orderkey IS NULL THEN 'order_present' END,
                              CASE WHEN NOT coalesce(l_quantity > 0, false) THEN 'quantity_positive' END,
                              CASE WHEN NOT coalesce(l_discount < 0.09, false) THEN 'discount_small' END,
                              CASE WHEN NOT coalesce(l_returnflag IN ('A', 'R'), false) THEN 'returned_or_open' END) AS broken_rules,
               count(*) AS row_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem GROUP BY 1""",
    "recon_bronze_silver": _with("fact", final=_checks(
        ("bronze_orders_vs_silver_orders", "(SELECT count(*) FROM latest_order)", "(SELECT count(DISTINCT order_id) FROM fact)"),
        ("silver_duplicate_line_keys",
         "(SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY order_id, line_number HAVING count(*) > 1))", "0"),
    )),
    "recon_orders_without_lines": _with("latest_order", "lines", final="""
        SELECT id AS order_id, status, total AS order_total FROM latest_order
        WHERE NOT EXISTS (SELECT 1 FROM lines WHERE order_id = id)"""),
    "recon_silver_gold": _with("kpis", final=_checks(
        ("order_count", "(SELECT count(DISTINCT order_id) FROM fact)", "(SELECT count(*) FROM kpis)"),
        ("units_sold", "(SELECT sum(quantity) FROM fact)", "(SELECT sum(units_sold) FROM kpis)"),
        ("sales_amount", "(SELECT sum(t) FROM (SELECT max(order_total) AS t FROM fact GROUP BY order_id))",
         "(SELECT sum(order_total) FROM kpis)"),
        ("gold_duplicate_orders", "(SELECT count(*) FROM (SELECT 1 FROM kpis GROUP BY order_id HAVING count(*) > 1))", "0"),
    )),
    "silver_order_metrics": _with("fact", final="""
        SELECT (SELECT count(DISTINCT order_id) FROM fact) AS order_count, (SELECT CAST(sum(quantity) AS BIGINT) FROM fact) AS units_sold,
               (SELECT CAST(sum(t) AS BIGINT) FROM (SELECT max(order_total) AS t FROM fact GROUP BY order_id)) AS sales_amount"""),
    "change_detection": _with("merged", final="""
        SELECT business_key, coalesce(new_status, '-') AS status, change_type FROM merged"""),
    "scd1_upsert": _with("merged", final="""
        SELECT business_key, CASE WHEN change_type = 'deleted' THEN old_custkey ELSE new_custkey END AS o_custkey,
               coalesce(CASE WHEN change_type = 'deleted' THEN old_status ELSE new_status END, '-') AS status FROM merged"""),
    "scd2_merge": _with("merged", final="""
        SELECT business_key, coalesce(old_status, '-') AS status, TIMESTAMP '2026-01-01 00:00:00' AS effective_from,
               CASE WHEN change_type = 'changed' THEN TIMESTAMP '2026-01-02 00:00:00' END AS effective_to,
               change_type <> 'changed' AS is_current
        FROM merged WHERE change_type <> 'new'
        UNION ALL
        SELECT business_key, coalesce(new_status, '-'), TIMESTAMP '2026-01-02 00:00:00', NULL, true
        FROM merged WHERE change_type IN ('new', 'changed')"""),
    "merge_metrics": _with("merged", final="""
        SELECT (SELECT count(*) FROM merge_source) AS source_rows, (SELECT count(*) FROM merge_target) AS target_rows,
               count(*) FILTER (WHERE change_type = 'new') AS new_rows, count(*) FILTER (WHERE change_type = 'changed') AS changed_rows,
               count(*) FILTER (WHERE change_type = 'unchanged') AS unchanged_rows, 0 AS stale_rows, strategy
        FROM merged CROSS JOIN (VALUES ('TYPE1'), ('TYPE2')) AS s(strategy) GROUP BY strategy"""),
    "medallion_batch": _with("fact", "kpis", final="SELECT order_id, order_total, units_sold, 'ALL/SUCCESS' AS run FROM kpis"),
    "gate_keeps_last_version": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "apply_configured_feed": f"SELECT user_id, event_id, value FROM ({_FEED_LAST}) WHERE event_type <> 'error'",
    "whole_documents": "SELECT CAST(s_nationkey AS BIGINT) AS nation, s_suppkey AS id FROM supplier",
    "bronze_lossless": """
        WITH e AS (SELECT event_id, '123456789012345' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS big FROM events),
        a AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN big || '.89' ELSE '0.5' END AS amount FROM e)
        SELECT big AS id, CAST(amount AS DOUBLE) AS amount, '-' AS rescued FROM a WHERE event_id % 7 <> 0
        UNION ALL SELECT '-', -1.0, '{"items":[{"amount":' || amount || ',"id":' || big || '}]}' FROM a
        WHERE event_id % 7 <> 0 AND event_id % 3 = 0
        UNION ALL SELECT '-', -1.0, '{"items":[{"id":' || big || ',"amount":' || amount || '}' FROM a WHERE event_id % 7 = 0""",
    "merge_table_type1": _with("merged", final="""
        SELECT business_key, CASE WHEN change_type = 'deleted' THEN old_custkey ELSE new_custkey END AS o_custkey,
               coalesce(CASE WHEN change_type = 'deleted' THEN old_status ELSE new_status END, '-') AS status FROM merged"""),
    "merge_table_type2": _with("merged", final="""
        SELECT business_key, coalesce(old_status, '-') AS status, TIMESTAMP '2026-01-01 00:00:00' AS effective_from,
               CASE WHEN change_type = 'changed' THEN TIMESTAMP '2026-01-02 00:00:00' END AS effective_to,
               change_type <> 'changed' AS is_current
        FROM merged WHERE change_type <> 'new'
        UNION ALL
        SELECT business_key, coalesce(new_status, '-'), TIMESTAMP '2026-01-02 00:00:00', NULL, true
        FROM merged WHERE change_type IN ('new', 'changed')"""),
    "merge_delta": _with("merged", final="""
        SELECT business_key, coalesce(new_status, '-') AS status, change_type FROM merged WHERE change_type IN ('new', 'changed')"""),
    "scd2_history": _history("user_id", "event_type"),
    "scd2_history_hot_keys": _history("event_type", "user_id"),
    "scd2_from_feed": _FEED_VERSIONS,
    "scd2_feed_batches": _FEED_VERSIONS,
    "scd2_backdated": _history("user_id", "event_type"),
    "scd2_many_snapshots": """
        WITH d AS (SELECT DISTINCT date_trunc('day', ts) AS day FROM events),
        n AS (SELECT CAST(day AS TIMESTAMP) AS day, row_number() OVER (ORDER BY day) AS k FROM d),
        s AS (SELECT user_id, event_type, event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events
              QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) = 1),
        -- Every user in every snapshot; NULL where the user is missing.
        g AS (SELECT u.user_id, n.k, n.day, s.event_type, s.event_id FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN n
              LEFT JOIN s ON s.user_id = u.user_id AND s.day = n.day),
        c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY k) AS previous FROM g),
        v AS (SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY k) AS end_at FROM c WHERE event_type IS DISTINCT FROM previous)
        SELECT user_id, event_type, event_id, day AS start_at, end_at FROM v WHERE event_type IS NOT NULL""",
    "upsert_in_buckets": """
        SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 50 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders
        UNION ALL SELECT -o_orderkey, o_custkey, 'X' FROM orders WHERE o_custkey % 50 = 1""",
    "append_replayed": """
        SELECT "table", o_orderkey, 'run-' || CAST(o_orderkey % 2 AS VARCHAR) AS batch FROM orders
        CROSS JOIN (VALUES ('raw'), ('full'), ('more')) AS t("table") WHERE "table" <> 'full' OR o_orderkey % 2 = 0""",
    "latest_after_merges": _with("latest_order", final="SELECT id, status, ingestion_timestamp, _source_file FROM latest_order"),
    "recon_rows": """
        WITH l AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
        r AS (SELECT l_orderkey, l_linenumber, q + CASE WHEN l_orderkey % 89 = 0 THEN 1 ELSE 0 END AS q FROM l WHERE l_orderkey % 97 <> 0
              UNION ALL SELECT -l_orderkey, l_linenumber, q FROM l WHERE l_orderkey % 83 = 0),
        a AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(q)) AS q FROM l GROUP BY 1, 2),
        b AS (SELECT l_orderkey, l_linenumber, count(*) AS n, list_sort(list(q)) AS q FROM r GROUP BY 1, 2)
        SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
               CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS difference,
               coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
        FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber WHERE a.q IS DISTINCT FROM b.q""",
    "large_documents": r"""
        SELECT o_orderkey AS id, 'a "}{[" \ ' || o_orderpriority AS text, o_custkey AS customer, true AS clean FROM orders
        UNION ALL SELECT -1, '}', 0, true""",
    "stable_keys": """
        SELECT c_custkey, row_number() OVER (ORDER BY c_custkey % 2, c_custkey) AS customer_no FROM customer""",
    "as_of_price": """
        WITH p AS (SELECT p_partkey, p_size, CAST(round(p_retailprice * 100) AS BIGINT) AS price FROM part),
        h AS (
            SELECT p_partkey, TIMESTAMP '1996-01-01' AS s, TIMESTAMP '1998-01-01' AS e, price FROM p
            UNION ALL SELECT p_partkey, TIMESTAMP '1998-01-01', CASE WHEN p_size < 10 THEN TIMESTAMP '2000-01-01' END, price + 100 FROM p
            UNION ALL SELECT p_partkey, TIMESTAMP '2001-01-01', NULL, price + 300 FROM p WHERE p_size < 10)
        SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, coalesce(price, -1) AS price_then FROM lineitem
        LEFT JOIN h ON p_partkey = l_partkey AND l_shipdate >= s AND (e IS NULL OR l_shipdate < e)""",
    "scd2_snapshot_fold": _with("weekly_versions", final="SELECT * FROM weekly_versions"),
    "scd2_stream": _with("weekly_versions", final="SELECT * FROM weekly_versions"),
    "global_row_number": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS line_sk
        FROM lineitem""",
    "apply_changes_hard": f"SELECT user_id, event_id, value FROM ({_FEED_LAST}) WHERE event_type <> 'error'",
    "apply_changes_late": f"SELECT user_id, event_id, value FROM ({_FEED_LAST}) WHERE event_type <> 'error'",
    "apply_changes_tombstones": f"SELECT user_id, event_id FROM ({_FEED_LAST}) WHERE event_type = 'error'",
    "apply_changes_soft": f"""
        SELECT user_id, event_id, value, event_type = 'error' AS is_deleted FROM ({_FEED_LAST})""",
    "landing_pages": _with("pulled_pages", final="""
        SELECT run_id, page_no, CAST(CASE WHEN st = 'F' THEN n ELSE least(2, greatest(0, n - (page_no - 1) * 2)) END AS INTEGER) AS page_records
        FROM pulled_pages"""),
    "landing_metrics": _with("pulled", final="""
        SELECT run_id, CAST(n AS BIGINT) AS records_read, CAST(pages_n AS BIGINT) AS pages_read, 0 AS broken_pages FROM pulled"""),
    "last_cursor": _with("pulled", final="""
        SELECT run_id, CASE WHEN st = 'P' AND pr = '1-URGENT' THEN 'cursor-' || pages_n
                            WHEN st = 'P' AND pages_n > 1 THEN 'cursor-' || (pages_n - 1) ELSE '-' END AS state_value
        FROM pulled"""),
    "incomplete_pulls": _with("pulled", final="""
        SELECT run_id, CAST(pages_n AS INTEGER) AS pages_read,
               CASE WHEN run_id % 10 = 3 THEN 'KEYSET' WHEN st = 'O' THEN 'OFFSET' ELSE 'CURSOR' END AS pagination_type
        FROM pulled WHERE run_id % 10 = 3 OR (st = 'O' AND (run_id % 10 = 7 OR (n > 0 AND n % 2 = 0))) OR (st = 'P' AND pr = '1-URGENT')"""),
    "split_landed_records": _with("pulled_pages", "lines", final="""
        SELECT l.order_id AS run_id, CAST(CASE WHEN p.pages_n = 1 THEN l.line_number ELSE (l.line_number + 1) // 2 END AS INTEGER) AS page_no,
               CAST(CASE WHEN p.pages_n = 1 THEN 1 ELSE (l.line_number - 1) % 2 + 1 END AS INTEGER) AS record_no,
               l.product_id, l.quantity, false AS rescued
        FROM lines l JOIN pulled p ON p.run_id = l.order_id WHERE p.st = 'O'
        UNION ALL SELECT run_id, page_no, 1, -1, -1, true FROM pulled_pages WHERE st <> 'O'"""),
    "envelope_records": _with("lines", final="SELECT order_id, product_id, quantity FROM lines"),
    "json_stream_bronze": """
        SELECT event_id, user_id, event_type, value, 'events' AS _api_id, true AS clean FROM events""",
    "fixed_schema_stream": "SELECT event_id, event_type, value, 'events' AS _api_id FROM events",
    "schema_evolution_rescue": """
        SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN -1.0 ELSE value END AS value,
               CASE WHEN event_type = 'purchase' THEN 'C-1' ELSE '-' END AS coupon,
               CASE WHEN event_type = 'error' THEN '{"value":"n/a"}' ELSE '-' END AS rescued
        FROM events""",
    "bronze_fan_out": "SELECT event_id, user_id, value, 'source=' || event_type AS _api_id FROM events",
    "latest_stream": _with("latest_order", final="""
        SELECT id, userId, status, total, _source_file, ingestion_timestamp FROM latest_order"""),
    "raw_payload_append": """
        SELECT 'orders_' || o_orderstatus AS api_name, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}' AS raw_payload
        FROM orders""",
    "load_mode_write": "SELECT event_id, event_type FROM events",
    "empty_result_write": "SELECT event_id, event_type FROM events WHERE false",
    "latest_checkpoints": _with("latest_points", final="SELECT * FROM latest_points"),
    "top_checkpoint": _with("points", final="""
        SELECT * FROM points WHERE api_id = (SELECT api_id FROM points GROUP BY 1 ORDER BY count(*) DESC, api_id LIMIT 1)
        ORDER BY recorded_at DESC, run_id DESC LIMIT 1"""),
    "effective_state": _with("config", "latest_points", final="""
        SELECT c.api_id, c.load_type,
               coalesce(strftime(CASE WHEN upper(c.load_type) <> 'FULL' THEN
                   (CASE WHEN p.api_id IS NULL THEN c.initial_value
                         WHEN upper(p.state_type) = 'WATERMARK' THEN p.recorded_at END) - to_minutes(c.overlap) END,
                   '%Y-%m-%dT%H:%M:%S.%gZ'), '-') AS watermark,
               coalesce(CASE WHEN upper(c.load_type) <> 'FULL' AND upper(p.state_type) = 'CURSOR' THEN p.state_value END, '-') AS cursor
        FROM config c LEFT JOIN latest_points p ON p.api_id = c.api_id"""),
    "checkpoint_append": _with("config", "points", final="""
        SELECT p.api_id, 'CURSOR' AS state_type, p.state_value, TIMESTAMP '2026-01-03 00:00:00' AS recorded_at, 'run-1' AS run_id
        FROM (SELECT *, row_number() OVER (PARTITION BY api_id ORDER BY recorded_at DESC, run_id DESC) AS rn
              FROM points WHERE state_type = 'Cursor') p JOIN config c ON c.api_id = p.api_id
        WHERE p.rn = 1 AND c.paging = 'CURSOR'
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), 'WATERMARK', strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%fZ'), TIMESTAMP '2026-01-03 00:00:00', 'run-1'
        FROM events GROUP BY user_id"""),
    "incremental_extract": """
        SELECT e.event_id, e.event_type, e.ts FROM events e
        JOIN (SELECT event_type, date_trunc('day', max(ts)) - INTERVAL 1 DAY AS mark FROM events GROUP BY 1) m
          ON m.event_type = e.event_type WHERE e.ts > m.mark""",
    "config_defaults": _with("config", final="""
        SELECT api_id, load_type, 'landing' AS landing_container, '' AS landing_path, 'BUFFER' AS download_mode,
               'next_cursor' AS cursor_field, 'cursor' AS cursor_parameter, 1 AS schema_version,
               CAST(c_nationkey AS VARCHAR) AS nation_header, 0 AS query_parameter_count FROM config"""),
    "enabled_sources": _with("config", final="""
        SELECT api_id, api_name, 'group-' || c_nationkey AS execution_group FROM config
        WHERE c_acctbal >= 0 AND c_nationkey < 12 ORDER BY api_name"""),
    "audit_report": _with("runs", final="""
        SELECT 'nightly_load' AS job_name, status, count(*) AS runs,
               CAST(coalesce(sum(CASE WHEN status = 'SUCCESS' THEN n END), 0) AS BIGINT) AS records_read, max(end_time) AS last_end
        FROM runs GROUP BY status"""),
    "run_summary": _with("latest_runs", final=f"""
        SELECT CAST(c.c_custkey AS VARCHAR) AS job_run_id, 'API Ingestion Run Summary - ' || s1 || ' - ' || c.c_custkey AS subject,
               {_BODY} AS body
        FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN 'FAILED' ELSE 'SUCCESS' END AS s1,
                     CASE WHEN c_acctbal < 0 THEN 'SKIPPED' ELSE 'SUCCESS' END AS s2,
                     CASE WHEN c_acctbal < 0 THEN 'NOT_EVALUATED' ELSE 'PASSED' END AS s3 FROM customer) c
        LEFT JOIN latest_runs r ON r.job_run_id = CAST(c.c_custkey AS VARCHAR)"""),
}

# The incremental models end where the full ones do.
ORACLE["gold_customer_sales_incremental"] = ORACLE["gold_customer_sales"]
ORACLE["gold_product_sales_incremental"] = ORACLE["gold_product_sales"]
ORACLE["merge_catalog_table"] = ORACLE["merge_table_type1"]
