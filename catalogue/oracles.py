"""DuckDB SQL with the same result as the query of the same name."""

VALUED = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity,
         CASE WHEN l_returnflag = 'R' THEN l_quantity * p_retailprice
              ELSE l_extendedprice END AS l_extendedprice
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""

FACT = f"""
SELECT c_custkey AS client_id, c_name AS name, c_mktsegment AS city, o_orderkey AS credit_id,
       o_orderpriority AS credit_type, o_totalprice AS total_amount_eur,
       o_totalprice AS balance_amount_eur, o_orderstatus AS credit_status,
       l_returnflag AS collateral_type, coalesce(l_extendedprice, 0) AS collateral_value_eur,
       CASE WHEN coalesce(l_extendedprice, 0) >= o_totalprice THEN 'YES' ELSE 'NO' END AS is_covered,
       CASE WHEN o_orderstatus = 'F' THEN 'HIGH' WHEN c_acctbal < 500 THEN 'HIGH'
            WHEN c_acctbal < 7000 THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk
FROM customer JOIN orders ON c_custkey = o_custkey
LEFT JOIN ({VALUED}) ON o_orderkey = l_orderkey
"""

GAPS = """
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         nullif(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders
"""


def result(rule: str, action: str, failed: str, ids: str | None = None) -> str:
    """One result row: `failed` selects the failing rows, `ids` names the sample column."""
    sample = "'no identifying column available'"
    if ids:
        sample = (
            f"(SELECT string_agg('{ids}=' || {ids}, ', ' ORDER BY {ids}) FROM "
            f"(SELECT {ids} FROM ({failed}) ORDER BY {ids} LIMIT 5))"
        )
    return f"""
SELECT '{rule}' AS rule, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n AS failed_rows,
       CASE WHEN n > 5 THEN {sample} || ' ... and ' || (n - 5) || ' more'
            WHEN n > 0 THEN {sample} END AS failed_ids,
       '{action}' AS action
FROM (SELECT count(*) AS n FROM ({failed}))
"""


def gaps(condition: str) -> str:
    return f"SELECT * FROM ({GAPS}) WHERE {condition}"


CHANGED = """
  SELECT o_orderkey + 500 AS o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         o_totalprice * 2 AS o_totalprice
  FROM orders
"""

UPSERTED = f"""
WITH changed AS ({CHANGED})
SELECT * FROM changed
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed)
"""


def money(column: str) -> str:
    return f"cast(cast({column} AS decimal(15, 2)) AS varchar)"


def silver_customers(shift: int) -> str:
    return f"""
        SELECT cast(c_custkey + {shift} AS varchar) AS c_custkey, c_name,
               cast(c_nationkey AS varchar) AS c_nationkey,
               upper(nullif(lower(c_mktsegment), 'furniture')) AS segment,
               'customer_run' AS _pipeline, 'silver' AS _layer
        FROM customer WHERE c_nationkey <> 3"""


def run_row(status: str, silver_count: str, error: str, more: str = "") -> str:
    """The log row of a customer run."""
    no_key = "count(*) FILTER (c_nationkey = 3)"
    no_segment = "count(*) FILTER (c_nationkey <> 3 AND c_mktsegment = 'FURNITURE')"
    return f"""
        SELECT 'customer_run' AS pipeline_name, '{status}' AS status, count(*) AS source_count,
               count(*) AS bronze_count, cast({silver_count} AS bigint) AS silver_count,
               cast(NULL AS bigint) AS gold_count,
               cast(({no_key} = 0)::int + ({no_segment} = 0)::int AS bigint) AS dq_passed,
               cast(({no_key} > 0)::int + ({no_segment} > 0)::int AS bigint) AS dq_failed,
               cast({error} AS varchar) AS error_message {more}
        FROM customer"""


CREDIT_RISK = f"""
        WITH collateral AS (
          SELECT DISTINCT l_orderkey, l_linenumber,
                 CASE l_returnflag WHEN 'R' THEN 'STOCKS' WHEN 'A' THEN 'HOME' ELSE 'CAR' END AS type,
                 cast(l_quantity AS int) AS numbers,
                 CASE WHEN l_returnflag <> 'R' THEN cast(l_extendedprice AS decimal(15, 2)) END AS price,
                 CASE WHEN l_returnflag = 'R' THEN l_partkey END AS stock
          FROM lineitem),
        valued AS (
          SELECT l_orderkey, type,
                 CASE WHEN type = 'STOCKS'
                      THEN cast(numbers AS double) * cast({money('p_retailprice')} AS double)
                      ELSE cast(price AS double) END AS value
          FROM collateral LEFT JOIN part ON stock = p_partkey)
        SELECT 'CLT-' || c_custkey AS client_id, c_name AS name, c_mktsegment AS city,
               'CRD-' || o_orderkey AS credit_id, o_orderpriority AS credit_type,
               {money('o_totalprice')} AS total_amount_eur,
               cast(cast(floor(o_totalprice / 10) AS bigint) AS varchar) AS balance_amount_eur,
               CASE o_orderstatus WHEN 'F' THEN 'DEFAULTED' WHEN 'O' THEN 'ACTIVE'
                    ELSE 'CLOSED' END AS credit_status,
               type AS collateral_type, coalesce(value, 0) AS collateral_value_eur,
               CASE WHEN coalesce(value, 0) >= floor(o_totalprice / 10)
                    THEN 'YES' ELSE 'NO' END AS is_covered,
               CASE WHEN o_orderstatus = 'F' OR 350 + c_custkey * 37 % 500 < 500 THEN 'HIGH'
                    WHEN 350 + c_custkey * 37 % 500 < 700 THEN 'MEDIUM' ELSE 'LOW' END AS overall_risk,
               'gold_pipeline' AS _pipeline, 'gold' AS _layer
        FROM customer JOIN orders ON c_custkey = o_custkey
        LEFT JOIN valued ON o_orderkey = l_orderkey"""

ORACLES = {
    "gold_risk_fact": FACT,
    "ordered_fact": f"{FACT} ORDER BY overall_risk",
    "csv_string_scan": """
        SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,
               o_orderstatus, o_orderpriority
        FROM orders""",
    "csv_without_header": """
        SELECT cast(c_custkey AS varchar) AS id, c_name AS name, cast(c_nationkey AS varchar) AS nation
        FROM customer""",
    "source_projection": "SELECT c_name, cast(c_custkey AS varchar) AS c_custkey FROM customer",
    "source_dedup": """
        SELECT DISTINCT cast(l_orderkey AS varchar) AS l_orderkey,
               cast(l_linenumber AS varchar) AS l_linenumber
        FROM lineitem""",
    "row_count": "SELECT count(*) AS n_written, count(*) AS n_read FROM lineitem",
    "upper_columns": "SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type FROM part",
    "cast_double": "SELECT o_orderkey, cast(cast(o_custkey AS varchar) AS double) AS o_custkey FROM orders",
    "audit_columns": """
        SELECT c_custkey, c_name, 'customer_run' AS _pipeline, 'silver' AS _layer, true AS _loaded_at
        FROM customer""",
    "left_enrich": VALUED,
    "drop_joined_columns": """
        SELECT l_orderkey, l_partkey, l_returnflag AS label,
               l_returnflag || ':' || p_name AS part_label
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "transform_chain": """
        SELECT l_orderkey, l_linenumber, upper(l_returnflag) AS collateral_type,
               cast(cast(l_quantity AS int) AS double) AS numbers,
               CASE WHEN l_returnflag = 'R' THEN cast(cast(l_quantity AS int) AS double) * p_size
                    ELSE cast(l_suppkey AS double) END AS valuation_eur,
               l_partkey AS stock_id
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "string_number_compare": """
        SELECT c_custkey, cast(cast(c_custkey AS varchar) AS bigint) < 500 AS lt,
               c_acctbal >= cast(cast(c_nationkey AS varchar) AS double) AS ge
        FROM customer""",
    "case_coalesce": """
        SELECT o_orderkey, coalesce(l_linenumber, 0) AS line, coalesce(l_extendedprice, 0) AS value,
               CASE WHEN coalesce(l_extendedprice, 0) >= o_totalprice THEN 'YES' ELSE 'NO' END AS covered,
               CASE WHEN o_orderstatus = 'F' THEN 'HIGH' WHEN l_linenumber < 3 THEN 'HIGH'
                    WHEN l_linenumber < 5 THEN 'MEDIUM' ELSE 'LOW' END AS band
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "inner_join": """
        SELECT c_custkey, c_name, o_orderkey, o_orderstatus
        FROM customer JOIN orders ON c_custkey = o_custkey""",
    "left_outer_join": """
        SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_returnflag
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "unused_left_join": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "unused_left_join_repeats": """
        SELECT o_orderkey, o_custkey FROM orders
        LEFT JOIN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey""",
    "not_null_report": result(
        "o_orderstatus_not_null", "drop_row", gaps("o_orderstatus IS NULL")
    )
    + "UNION ALL"
    + result("o_orderkey_not_null", "drop_row", gaps("o_orderkey IS NULL")),
    "not_null_sequential": result(
        "o_orderstatus_not_null", "drop_row", gaps("o_orderstatus IS NULL")
    )
    + "UNION ALL"
    + result(
        "o_orderpriority_not_null",
        "report",
        gaps("o_orderstatus IS NOT NULL AND o_orderpriority IS NULL"),
    )
    + "UNION ALL"
    + result(
        "o_orderpriority_not_null",
        "drop_row",
        gaps("o_orderstatus IS NOT NULL AND o_orderpriority IS NULL"),
    )
    + "UNION ALL"
    + result("o_orderpriority_not_null", "drop_row", gaps("false")),
    "failed_id_sample": result(
        "o_orderstatus_not_null", "drop_row", gaps("o_orderstatus IS NULL"), "o_orderkey"
    )
    + "UNION ALL"
    + result(
        "o_orderpriority_not_null",
        "drop_row",
        gaps("o_orderstatus IS NOT NULL AND o_orderpriority IS NULL"),
        "o_orderkey",
    ),
    "dq_unknown_column": """
        SELECT 'no_such_column_not_null' AS rule, 'ERROR' AS status, cast(NULL AS bigint) AS failed_rows,
               cast(NULL AS varchar) AS failed_ids, 'drop_row' AS action
        UNION ALL"""
    + result("o_orderstatus_not_null", "drop_row", gaps("o_orderstatus IS NULL")),
    "not_null_drop": gaps("o_orderstatus IS NOT NULL"),
    "not_null_report_only": GAPS,
    "dq_summary": f"""
        SELECT cast(count(*) FILTER (n = 0) AS bigint) AS dq_passed,
               cast(count(*) FILTER (n > 0) AS bigint) AS dq_failed
        FROM (SELECT count(*) AS n FROM ({GAPS}) WHERE o_orderstatus IS NULL
              UNION ALL SELECT count(*) FROM ({GAPS})
                        WHERE o_orderstatus IS NOT NULL AND o_orderkey IS NULL
              UNION ALL SELECT count(*) FROM ({GAPS})
                        WHERE o_orderstatus IS NOT NULL AND o_custkey IS NULL)""",
    "dq_results": "SELECT 'orders_run' AS pipeline_name, *, true AS checked_at FROM ("
    + result("o_orderstatus_not_null", "drop_row", gaps("o_orderstatus IS NULL"), "o_custkey")
    + "UNION ALL"
    + result("o_orderkey_not_null", "drop_row", gaps("o_orderkey IS NULL"), "o_custkey")
    + ")",
    "overwrite_replace": "SELECT * FROM customer",
    "append_evolve": """
        SELECT c_custkey AS id, c_name AS name, cast(NULL AS int) AS nation FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
        UNION ALL SELECT c_custkey, c_name, NULL FROM customer""",
    "silver_first_load": "SELECT * FROM orders",
    "upsert_merge": UPSERTED,
    "upsert_idempotent": UPSERTED,
    "upsert_repeated_target_keys": """
        WITH s AS (SELECT o_orderkey * 2 AS k, o_orderstatus AS flag FROM orders)
        SELECT l_orderkey AS k, coalesce(flag, l_returnflag) AS flag,
               CASE WHEN flag IS NULL THEN l_linenumber ELSE 0 END AS n
        FROM lineitem LEFT JOIN s ON l_orderkey = k
        UNION ALL
        SELECT k, flag, 0 FROM s WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""",
    "upsert_unmatched_keys": """
        SELECT o_orderkey AS k, o_orderstatus AS flag FROM orders
        UNION ALL
        SELECT CASE WHEN l_returnflag <> 'R' THEN -1 - l_orderkey END, l_linestatus FROM lineitem""",
    "upsert_touched_partitions": """
        WITH old AS (SELECT cast(cast(o_orderdate AS date) AS varchar) AS day, o_orderkey, o_orderpriority AS note FROM orders),
        last AS (SELECT max(day) AS day FROM old)
        SELECT day, CASE WHEN l THEN -1 ELSE o_orderkey END AS o_orderkey, CASE WHEN l THEN 'closed' ELSE note END AS note
        FROM (SELECT *, day = (SELECT day FROM last) AS l FROM old)
        UNION ALL
        SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN 'no day' END, o_orderkey, 'open'
        FROM orders WHERE o_orderstatus = 'P'""",
    "upsert_bucketed": UPSERTED,
    "append_compacted": """
        SELECT id, name, nation, true AS few_files FROM (
          SELECT c_custkey AS id, c_name AS name, cast(NULL AS int) AS nation FROM customer
          UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier), range(3) AS times(k)""",
    "csv_malformed": """
        SELECT cast(o_orderkey AS varchar) AS id, o_orderstatus AS status, o_orderpriority AS priority, 'FAIL' AS bad_status,
               (SELECT count(*) FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT')) AS bad_lines
        FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')""",
    "gold_sorted": f"SELECT *, cast(0 AS bigint) AS overlaps FROM ({FACT})",
    "csv_to_silver": silver_customers(0),
    "silver_reload": f"""
        WITH old AS ({silver_customers(0)}), new AS ({silver_customers(100)})
        SELECT * FROM new
        UNION ALL
        SELECT * FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""",
    "run_log": run_row("SUCCESS", "count(*) FILTER (c_nationkey <> 3)", "NULL", ", true AS timed"),
    "failed_run_log": run_row("FAILED", "NULL", "'a transformation step cannot be ''lowercase'''"),
    "gold_sql_text": """
        SELECT o_orderkey AS order_key, l_linestatus AS line_status,
               coalesce(l_extendedprice, 0) AS value,
               CASE WHEN l_extendedprice >= o_totalprice THEN 'YES' ELSE 'NO' END AS covers,
               'gold_text' AS _pipeline, 'gold' AS _layer
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "credit_risk_run": CREDIT_RISK,
    "gold_sql_fact": CREDIT_RISK,
    "typed_silver": """
        SELECT CASE WHEN c_nationkey <> 3 THEN c_custkey END AS c_custkey, c_name, c_nationkey,
               cast(NULL AS double) AS segment, 'segment_is_double' AS bad_rule,
               (SELECT count(*) FROM customer WHERE lower(c_mktsegment) <> 'furniture') AS bad_rows
        FROM customer""",
}
