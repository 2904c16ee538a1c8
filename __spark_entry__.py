
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.plans import retail

try:
    import corpus_pipeline
    from martloom.llm import registry as llm
except ImportError:  # the library without its subpackage of training-data operators
    llm = None

SMOKE_FOLDER = "/root/testdata/sf0.001"

# Oracle pieces shared by several queries.
WIDE = """orders LEFT JOIN events ON o_custkey = user_id
    LEFT JOIN conversations ON o_custkey = conv_id"""
MERGE = """(SELECT l_orderkey AS order_id, l_linestatus AS status, l_extendedprice AS amount,
           l_shipdate AS changed_at FROM lineitem) t
    FULL JOIN (SELECT event_id AS order_id, event_type AS status,
           CASE WHEN event_type <> 'error' THEN value END AS amount, ts AS changed_at
           FROM events) s ON t.order_id = s.order_id"""
MERGED = f"""
    SELECT coalesce(s.order_id, t.order_id) AS order_id,
           CASE WHEN s.order_id IS NOT NULL THEN s.status ELSE t.status END AS status,
           CASE WHEN s.order_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
           CASE WHEN s.order_id IS NOT NULL THEN s.changed_at ELSE t.changed_at END AS changed_at
    FROM {MERGE}"""

# The texts of the contract queries, and whether a text's id is a whole number.
EVENT_TEXTS = """(
    SELECT event_id, CASE event_id % 11
        WHEN 0 THEN '{"id":' || event_id || ',"msg":"' || event_type || '"}'
        WHEN 1 THEN '{"id":"' || event_id || '","msg":"' || event_type || '"}'
        WHEN 2 THEN '[' || event_id || ']'
        WHEN 3 THEN '{"id":' || event_id || ',"msg":"' || event_type
        WHEN 4 THEN '{"msg":"' || event_type || '"}'
        WHEN 5 THEN 'null'
        WHEN 6 THEN '{"id":' || event_id || 'e19,"msg":"' || event_type || '"}'
        WHEN 7 THEN '{"id":' || event_id || ',"msg":' || event_id || '}'
        WHEN 8 THEN '{"id":null,"msg":"' || event_type || '"}'
        WHEN 9 THEN '{"id":' || event_id || '.5,"msg":"' || event_type || '"}'
        ELSE '{"id":' || event_id || ',"msg":"' || event_type || '","more":[1]}' END AS value
    FROM events)"""
WHOLE = """(json_type(value, '$.id') IN ('BIGINT', 'UBIGINT', 'HUGEINT')
    OR json_type(value, '$.id') = 'DOUBLE'
       AND CAST(json_extract_string(value, '$.id') AS DOUBLE)
           = round(CAST(json_extract_string(value, '$.id') AS DOUBLE)))"""


# The nested messages, with a fault of each kind by turns.
NESTED_TEXTS = """(
    SELECT event_id, '{"id":' || CASE WHEN event_id % 12 = 1 THEN '-' ELSE '' END || event_id
        || ',"user":{' || CASE event_id % 12 WHEN 2 THEN '"id":"' || event_id || '",'
            WHEN 3 THEN '' ELSE '"id":' || event_id || ',' END
        || '"mail":"' || CASE WHEN event_id % 12 = 4 THEN 'ab' ELSE 'a@b' END
        || '"},"kind":' || CASE WHEN event_id % 12 = 5 THEN '"none"' ELSE 'null' END
        || ',"props":' || CASE WHEN event_id % 12 = 6 THEN '[' || props || ']' ELSE props END
        || ',"items":' || CASE WHEN event_id % 12 = 11 THEN '' ELSE '[' END || '{"n":1},'
        || CASE event_id % 12 WHEN 7 THEN '{"n":10}' WHEN 8 THEN '{"m":2.5}'
            WHEN 9 THEN '{"n":2.5,"m":1}' WHEN 10 THEN '{"n":2},{"n":3},{"n":4}'
            ELSE '{"n":2.5}' END || ']}' AS value
    FROM events)"""


# Users' contracts by version: the property beside id, its types as bits (1 integer, 2 number,
# 4 null; 127 any), whether it is required, and whether others are refused.
USER_CONTRACTS = """
    SELECT user_id || '-value' AS subject, event_id AS version, event_type AS name,
           CASE CAST(floor(abs(value)) AS BIGINT) % 4
               WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 5 ELSE 127 END AS types,
           CAST(floor(abs(value)) AS BIGINT) % 3 = 0 AS required, event_type = 'error' AS closed
    FROM events"""


def _accepts(one: str, other: str) -> str:
    """SQL: whether a contract accepts all that another one does."""
    return f"""(
        (NOT {one}.required OR ({other}.required AND {other}.name = {one}.name))
        AND CASE WHEN {other}.name = {one}.name THEN ({other}.types & ~{one}.types) = 0
                 ELSE {other}.closed OR {one}.types = 127 END
        AND (NOT {one}.closed OR ({other}.closed AND {other}.name = {one}.name)))"""


def entry(spark: SparkSession) -> DataFrame:
    """The star mart: order lines with order, supplier and the supplier's nation."""
    return retail.core_star_left(spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "scan_row_count": retail.scan_row_count,
        "rename_project": retail.rename_project,
        "core_star_left": retail.core_star_left,
        "left_join_unmatched": retail.left_join_unmatched,
        "wide_mart_left": retail.wide_mart_left,
        "wide_mart_reduced": retail.wide_mart_reduced,
        "wide_mart_star": retail.wide_mart_star,
        "inner_join_five_way": retail.inner_join_five_way,
        "fanout_report": retail.fanout_report,
        "fanout_bound": retail.fanout_bound,
        "filter_not_null_count": retail.filter_not_null_count,
        "preview_limit": retail.preview_limit,
        "expect_not_null": retail.expect_not_null,
        "expect_unique_groups": retail.expect_unique_groups,
        "expect_row_count": retail.expect_row_count,
        "expectation_report": retail.expectation_report,
        "expectation_delta": retail.expectation_delta,
        "merge_upsert": retail.merge_upsert,
        "merge_action_counts": retail.merge_action_counts,
        "merge_bucketed": retail.merge_bucketed,
        "merge_changes": retail.merge_changes,
        "merge_conflicts": retail.merge_conflicts,
        "mart_write_read": retail.mart_write_read,
        "mart_load": retail.mart_load,
        "mart_keys_found": retail.mart_keys_found,
        "message_frame": retail.message_table,
        "contract_check": retail.contract_check,
        "contract_backtest": retail.contract_backtest,
        "delivery_report": retail.delivery_report,
        "preview_wide": retail.preview_wide,
        "sql_view_join": retail.sql_view_join,
        "contract_verdicts": retail.contract_verdicts,
        "contract_closed": retail.contract_closed,
        "contract_nested": retail.contract_nested,
        "contract_history": retail.contract_versions,
        "publish_report": retail.publish_report,
        "delivery_outcomes": retail.delivery_outcomes,
        "publish_stream": retail.publish_stream,
    }
    return found | llm.queries() | {"pipeline": corpus_pipeline.run} if llm else found


# The verdict of the event messages by the contract of an id and a text.
EVENT_VERDICTS = f"""
            SELECT event_id, value,
                   CASE WHEN NOT json_valid(value) THEN 'not_json'
                        WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
                        WHEN json_type(value, '$.id') IS NULL THEN 'missing:id'
                        WHEN json_type(value, '$.msg') IS NULL THEN 'missing:msg'
                        WHEN NOT {WHOLE} THEN 'type:id'
                        WHEN json_type(value, '$.msg') <> 'VARCHAR' THEN 'type:msg'
                        ELSE 'ok' END AS verdict
            FROM {EVENT_TEXTS}"""


def oracle_sql() -> dict[str, str]:
    found = {
        "scan_row_count": "SELECT count(*) AS row_count FROM orders",
        "rename_project": """
            SELECT c_custkey AS customer_id, c_name AS customer_name,
                   c_mktsegment AS customer_segment FROM customer""",
        "core_star_left": """
            SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS order_cust_id,
                   o_orderdate AS order_ts, l_suppkey AS supp_id, s_name AS supp_name,
                   s_nationkey AS nation_id, n_name AS nation_name, l_quantity, l_extendedprice
            FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
            LEFT JOIN supplier ON l_suppkey = s_suppkey
            LEFT JOIN nation ON s_nationkey = n_nationkey""",
        "left_join_unmatched": """
            SELECT d.doc_id, lang, quality, toxic
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "wide_mart_left": f"""
            SELECT o_orderkey AS order_id, o_custkey AS cust_id, event_id, event_type, turn, role
            FROM {WIDE}""",
        "wide_mart_reduced": f"""
            SELECT o_orderkey AS order_id, o_custkey AS cust_id, event_id, event_type, turn, role
            FROM {WIDE}""",
        "wide_mart_star": """
            SELECT o_orderkey AS order_id, o_custkey AS cust_id, c_name AS customer_name,
                   c_nationkey AS nation_id, n_name AS nation_name, event_id, event_type, turn, role
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN events ON o_custkey = user_id
            LEFT JOIN conversations ON o_custkey = conv_id""",
        "inner_join_five_way": """
            SELECT o_orderkey, c_custkey, n_name, event_id, turn
            FROM orders a JOIN customer b ON a.o_custkey = b.c_custkey
            JOIN nation c ON b.c_nationkey = c.n_nationkey
            JOIN events d ON b.c_custkey = d.user_id
            JOIN conversations e ON e.conv_id = b.c_custkey""",
        "fanout_report": """
            WITH c AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY user_id),
                 r AS (SELECT conv_id AS k, count(*) AS n FROM conversations GROUP BY conv_id),
                 f AS (SELECT greatest(1, coalesce(c.n, 0)) * greatest(1, coalesce(r.n, 0))
                              AS fanout
                       FROM orders LEFT JOIN c ON o_custkey = c.k LEFT JOIN r ON o_custkey = r.k)
            SELECT count(*) AS fact_rows, CAST(sum(fanout) AS BIGINT) AS wide_rows,
                   max(fanout) AS max_fanout FROM f""",
        "fanout_bound": f"""
            SELECT count(*) AS wide_rows, true AS bound_holds FROM {WIDE}""",
        "filter_not_null_count": f"""
            SELECT count(*) AS row_count FROM {WIDE} WHERE event_type IS NOT NULL""",
        "preview_limit": """
            SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10""",
        "expect_not_null": f"""
            WITH w AS (SELECT o_orderkey AS order_id, o_custkey AS cust_id, event_id, turn
                       FROM {WIDE}),
                 v AS (SELECT 'order_id' AS column_name,
                              count(*) FILTER (WHERE order_id IS NULL) AS violations FROM w
                       UNION ALL
                       SELECT 'cust_id', count(*) FILTER (WHERE cust_id IS NULL) FROM w
                       UNION ALL
                       SELECT 'event_id', count(*) FILTER (WHERE event_id IS NULL) FROM w
                       UNION ALL SELECT 'turn', count(*) FILTER (WHERE turn IS NULL) FROM w)
            SELECT column_name, violations, violations = 0 AS passed FROM v""",
        "expect_unique_groups": f"""
            SELECT event_id, count(*) AS n FROM {WIDE} GROUP BY event_id HAVING count(*) > 1""",
        "expect_row_count": f"""
            SELECT count(*) AS row_count, count(*) >= 1 AS min_ok, count(*) <= 50000000 AS max_ok
            FROM {WIDE}""",
        "expectation_report": """
            WITH w AS (SELECT o_orderkey AS order_id, event_id
                       FROM orders LEFT JOIN events ON o_custkey = user_id),
                 v AS (SELECT 'not_null' AS rule, 'order_id' AS column_name,
                              count(*) FILTER (WHERE order_id IS NULL) AS violations FROM w
                       UNION ALL SELECT 'not_null', 'event_id',
                              count(*) FILTER (WHERE event_id IS NULL) FROM w
                       UNION ALL SELECT 'unique', 'order_id', count(*)
                              FROM (SELECT order_id FROM w GROUP BY order_id
                                    HAVING count(*) > 1) g
                       UNION ALL SELECT 'row_count_min', '*',
                              CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM w)
            SELECT rule, column_name, violations, violations = 0 AS passed FROM v""",
        "expectation_delta": f"""
            WITH w AS ({MERGED}),
                 v AS (SELECT 'not_null' AS rule, 'order_id' AS column_name,
                              count(*) FILTER (WHERE order_id IS NULL) AS violations FROM w
                       UNION ALL SELECT 'not_null', 'amount',
                              count(*) FILTER (WHERE amount IS NULL) FROM w
                       UNION ALL SELECT 'row_count_min', '*',
                              CASE WHEN count(*) < 1 THEN 1 ELSE 0 END FROM w
                       UNION ALL SELECT 'row_count_max', '*',
                              CASE WHEN count(*) > 50000000 THEN 1 ELSE 0 END FROM w
                       UNION ALL SELECT 'unique', 'order_id', count(*)
                              FROM (SELECT order_id FROM w GROUP BY order_id
                                    HAVING count(*) > 1) g)
            SELECT rule, column_name, violations, violations = 0 AS passed FROM v""",
        "merge_upsert": MERGED,
        "merge_action_counts": f"""
            SELECT CASE WHEN s.order_id IS NULL THEN 'untouched'
                        WHEN t.order_id IS NULL THEN 'inserted' ELSE 'updated' END AS action,
                   count(*) AS n
            FROM {MERGE} GROUP BY 1""",
        "merge_bucketed": MERGED,
        "merge_changes": f"""
            SELECT CASE WHEN t.order_id IS NULL THEN 'inserted' ELSE 'updated' END AS action,
                   t.order_id AS before_order_id, t.status AS before_status,
                   t.amount AS before_amount, t.changed_at AS before_changed_at,
                   s.order_id AS after_order_id, s.status AS after_status,
                   s.amount AS after_amount, s.changed_at AS after_changed_at
            FROM {MERGE} WHERE s.order_id IS NOT NULL""",
        "merge_conflicts": f"""
            SELECT o_orderkey AS order_id, count(*) AS n_source_rows FROM {WIDE}
            WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
            GROUP BY o_orderkey HAVING count(*) > 1""",
        "mart_write_read": """
            SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date
            FROM orders""",
        "mart_load": MERGED,
        "mart_keys_found": """
            SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS changed_in,
                   count(DISTINCT l_orderkey) AS n_keys
            FROM lineitem WHERE l_orderkey IN (SELECT event_id FROM events) GROUP BY 1""",
        "message_frame": """
            SELECT CAST(event_id AS VARCHAR) AS key,
                   '{"id":' || event_id || ',"msg":"' || event_type || '"}' AS value
            FROM events""",
        "contract_check": """
            SELECT d.doc_id,
                   CASE WHEN quality IS NULL THEN 'missing:quality' ELSE 'ok' END AS verdict
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "contract_backtest": """
            SELECT count(*) AS n_messages, count(*) FILTER (WHERE quality IS NULL) AS n_newly_broken
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "delivery_report": """
            SELECT count(*) AS n_sent, count(*) FILTER (WHERE event_id IS NULL) AS n_null_keys
            FROM events""",
        "preview_wide": f"""
            SELECT o_orderkey AS order_id, o_custkey AS cust_id, event_id, event_type, turn, role
            FROM {WIDE}
            ORDER BY order_id NULLS FIRST, cust_id NULLS FIRST, event_id NULLS FIRST,
                     event_type NULLS FIRST, turn NULLS FIRST, role NULLS FIRST LIMIT 10""",
        "sql_view_join": """
            SELECT c_mktsegment, event_type, count(*) AS n_events
            FROM events JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment, event_type""",
        "contract_verdicts": EVENT_VERDICTS,
        "publish_stream": f"""
            SELECT count(*) FILTER (WHERE verdict = 'ok') AS n_due,
                   count(*) FILTER (WHERE verdict = 'ok') AS n_acknowledged,
                   CAST(0 AS BIGINT) AS n_failed,
                   count(*) FILTER (WHERE verdict <> 'ok') AS n_refused
            FROM ({EVENT_VERDICTS})""",
        "contract_closed": f"""
            SELECT event_id,
                   CASE WHEN NOT json_valid(value) THEN 'not_json'
                        WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
                        WHEN json_type(value, '$.id') IS NULL THEN 'missing:id'
                        WHEN NOT ({WHOLE} OR json_type(value, '$.id') = 'NULL') THEN 'type:id'
                        WHEN len([k FOR k IN json_keys(value) IF k NOT IN ('id', 'msg')]) > 0 THEN 'extra'
                        ELSE 'ok' END AS verdict
            FROM {EVENT_TEXTS}""",
        "contract_history": f"""
            WITH v AS ({USER_CONTRACTS}),
                 p AS (SELECT new.subject, new.version, {_accepts("new", "old")} AS backward,
                              {_accepts("old", "new")} AS forward
                       FROM v new JOIN v old
                       ON new.subject = old.subject AND old.version < new.version),
                 h AS (SELECT subject, version, bool_and(backward) AS backward,
                              bool_and(forward) AS forward FROM p GROUP BY 1, 2)
            SELECT subject, version, coalesce(backward, true) AS backward,
                   coalesce(forward, true) AS forward,
                   coalesce(backward AND forward, true) AS "full"
            FROM v LEFT JOIN h USING (subject, version)""",
        "contract_nested": f"""
            SELECT event_id,
                   CASE WHEN NOT json_valid(value) THEN 'not_json'
                        WHEN CAST(value->>'$.id' AS BIGINT) < 0 THEN 'minimum:id'
                        WHEN json_type(value, '$.user.id') IS NULL THEN 'missing:user.id'
                        WHEN json_type(value, '$.user.id') = 'VARCHAR' THEN 'type:user.id'
                        WHEN value->>'$.user.mail' NOT LIKE '%@%' THEN 'pattern:user.mail'
                        WHEN json_type(value, '$.kind') <> 'NULL' THEN 'enum:kind'
                        WHEN json_type(value, '$.props') <> 'OBJECT' THEN 'type:props'
                        WHEN json_array_length(value, '$.items') > 3 THEN 'maxItems:items'
                        WHEN json_type(value, '$.items[1].n') IS NULL THEN 'missing:items[1].n'
                        WHEN CAST(value->>'$.items[1].n' AS DOUBLE) >= 10
                            THEN 'exclusiveMaximum:items[1].n'
                        WHEN len(json_keys(value, '$.items[1]')) > 1 THEN 'extra:items[1]'
                        ELSE 'ok' END AS verdict
            FROM {NESTED_TEXTS}""",
        "delivery_outcomes": """
            SELECT event_id % 4 AS part, count(*) AS n_due,
                   count(*) FILTER (WHERE event_id % 4 <> 3
                       AND strlen('{"id":' || event_id || ',"msg":"' || event_type || '"}') <= 26)
                       AS n_acknowledged,
                   count(*) FILTER (WHERE event_id % 4 = 3
                       OR strlen('{"id":' || event_id || ',"msg":"' || event_type || '"}') > 26)
                       AS n_failed
            FROM events GROUP BY 1""",
        "publish_report": """
            SELECT count(*) AS n_due, count(quality) AS n_sent,
                   count(*) - count(quality) AS n_rejected,
                   count(*) FILTER (WHERE d.doc_id IS NULL) AS n_null_keys
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    }
    return found | llm.oracle_sql() if llm else found
