"""The registered queries in plain SQL over the input tables."""

from __future__ import annotations

_CL = """
cl AS (
  SELECT user_id AS id, event_type AS name, value AS weight, props AS description,
         CASE WHEN event_id % 2 = 1 THEN event_id END AS revision,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r'
                         ELSE 'u' END AS op,
         event_id, ts,
         CAST(CASE WHEN event_id % 2 = 1 THEN 3 ELSE 2 END AS INTEGER) AS "valueSchemaId"
  FROM events
)"""

_LATEST = f"""{_CL},
latest AS (
  SELECT * FROM (
    SELECT cl.*, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn
    FROM cl
  ) WHERE rn = 1
)"""

_STATE = f"""
WITH {_LATEST}
SELECT id, name, weight, description, revision, op FROM latest WHERE op <> 'd'"""

_LINE_ORDER_DESC = ", ".join(
    f"{c} DESC"
    for c in (
        "l_shipdate l_linenumber l_partkey l_suppkey l_quantity l_extendedprice "
        "l_discount l_tax l_returnflag l_linestatus"
    ).split()
)
_LINE_ORDER_ASC = _LINE_ORDER_DESC.replace(" DESC", "")

_OL = f"""
ol AS (
  SELECT l_orderkey AS o_orderkey, l_suppkey AS o_custkey, l_linestatus AS o_orderstatus,
         l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate,
         CASE l_returnflag WHEN 'R' THEN 'd' WHEN 'A' THEN 'u' ELSE 'c' END AS op
  FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_DESC}) AS rn
    FROM lineitem
  ) WHERE rn = 1
)"""


def _pick(*columns: str) -> str:
    return ", ".join(
        f"CASE WHEN c.op IS NOT NULL THEN c.{c} ELSE t.{c} END AS {c}" for c in columns
    )


_MERGED_ORDERS = f"""
WITH {_OL}
SELECT {_pick("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")},
       t.o_orderpriority, c.op
FROM orders t FULL OUTER JOIN ol c ON t.o_orderkey = c.o_orderkey
WHERE c.op IS NULL OR c.op <> 'd'"""

_LANDED = f"""
WITH {_CL}
SELECT 'dbserver1.inventory.products' AS topic, CAST(id % 4 AS INTEGER) AS partition,
       event_id AS offset_no, ts AS captured_at, id, op
FROM cl"""

_FLAT = f"""
WITH {_CL}
SELECT event_id AS offset_no, id AS key_id, op,
       CASE WHEN op IN ('u', 'd') THEN id END AS before_id,
       CASE WHEN op IN ('u', 'd') THEN name END AS before_name,
       CASE WHEN op IN ('u', 'd') THEN weight END AS before_weight,
       CASE WHEN op IN ('u', 'd') THEN description END AS before_description,
       CASE WHEN op IN ('u', 'd') THEN revision END AS before_revision,
       CASE WHEN op <> 'd' THEN id END AS after_id,
       CASE WHEN op <> 'd' THEN name END AS after_name,
       CASE WHEN op <> 'd' THEN weight END AS after_weight,
       CASE WHEN op <> 'd' THEN description END AS after_description,
       CASE WHEN op <> 'd' THEN revision END AS after_revision
FROM cl"""

_ROWS = f"""
WITH {_CL}
SELECT id, name, weight, description, revision, op FROM cl"""

ORACLES: dict[str, str] = {
    "cdc_latest_per_key": f"""
WITH {_LATEST}
SELECT id, op, event_id AS offset_no, ts AS changed_at, "valueSchemaId" FROM latest""",
    "cdc_current_state": _STATE,
    "cdc_change_rows": _ROWS,
    "cdc_merge_customers": f"""
WITH {_LATEST},
t AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS weight, c_mktsegment AS description
      FROM customer)
SELECT {_pick("id", "name", "weight", "description")}, c.revision, c.op
FROM t FULL OUTER JOIN latest c ON t.id = c.id
WHERE c.op IS NULL OR c.op <> 'd'""",
    "cdc_delete_without_image": _STATE,
    "cdc_merge_orders": _MERGED_ORDERS,
    "cdc_merge_composite": f"""
WITH t AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY {_LINE_ORDER_ASC}) AS rn
    FROM lineitem WHERE l_linestatus = 'F'
  ) WHERE rn = 1
),
c AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 'd' ELSE 'u' END AS op FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY {_LINE_ORDER_DESC}) AS rn
    FROM lineitem
  ) WHERE rn = 1
)
SELECT {_pick("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_shipdate")}, c.op
FROM t FULL OUTER JOIN c
  ON t.l_orderkey = c.l_orderkey AND t.l_linenumber = c.l_linenumber
WHERE c.op IS NULL OR c.op <> 'd'""",
    "cdc_schema_pairs": f"""
WITH {_CL}
SELECT DISTINCT CAST(1 AS INTEGER) AS "keySchemaId", "valueSchemaId" FROM cl""",
    "cdc_schema_route": f"""
WITH {_CL}
SELECT event_id AS offset_no, "valueSchemaId", id, name, weight, description, revision FROM cl""",
    "frame_decode_ids": """
SELECT event_id, CAST((user_id + 1) % 2147483647 AS INTEGER) AS "keySchemaId",
       CAST(event_id * 1000 % 2147483647 AS INTEGER) AS "valueSchemaId",
       event_type AS key_text, props AS value_text
FROM events""",
    "avro_decode": _FLAT,
    "protobuf_decode": f"""
SELECT * EXCLUDE (before_revision, after_revision) FROM ({_FLAT})""",
    "json_envelope_decode": _FLAT,
    "topic_address": """
SELECT doc_id, 'dbserver1' AS project_name, source AS database, lang AS table_name,
       concat('s3://datalake-raw/dbserver1/', source, '/', lang) AS raw_path
FROM documents""",
    "synthetic_products": """
SELECT md5('name:' || o_orderkey::VARCHAR) AS name,
       md5('description:' || o_orderkey::VARCHAR) AS description,
       ('0x' || substr(md5('weight:' || o_orderkey::VARCHAR), 1, 12))::BIGINT % 1000000 AS weight
FROM orders""",
    "layer_roundtrip_parquet": "SELECT * FROM lineitem",
    "layer_roundtrip_orc": "SELECT * FROM orders",
    "layer_roundtrip_json": "SELECT * FROM events",
    "layer_roundtrip_csv": "SELECT * FROM customer",
    "layer_roundtrip_text": "SELECT * FROM documents",
    "layer_stream_parquet": "SELECT * FROM orders",
    "layer_stream_orc": "SELECT * FROM customer",
    "layer_stream_json": "SELECT * FROM events",
    "layer_stream_csv": "SELECT * FROM documents",
    "layer_stream_text": "SELECT * FROM conversations",
    "append_evolution": _ROWS,
    "record_ingest": "SELECT * FROM conversations",
    "table_merge_orders": _MERGED_ORDERS,
    "table_append_orders": f"""
WITH {_OL}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(NULL AS VARCHAR) AS op FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, op FROM ol""",
    "table_grown_buckets": _MERGED_ORDERS,
    "merge_widened": _MERGED_ORDERS,
    "merge_pruned_files": f"SELECT *, true AS always_skipped FROM ({_MERGED_ORDERS})",
    "version_changes": f"""
WITH new AS ({_MERGED_ORDERS}),
old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               CAST(NULL AS VARCHAR) AS op FROM orders),
gone AS (SELECT * FROM old EXCEPT SELECT * FROM new),
come AS (SELECT * FROM new EXCEPT SELECT * FROM old)
SELECT coalesce(gone.o_orderkey, come.o_orderkey) AS o_orderkey,
       CASE WHEN gone.o_orderkey IS NULL THEN 'insert' WHEN come.o_orderkey IS NULL THEN 'delete'
            ELSE 'update' END AS change,
       gone.o_totalprice AS price_before, come.o_totalprice AS price_after, come.op
FROM gone FULL OUTER JOIN come ON gone.o_orderkey = come.o_orderkey""",
    "table_time_travel": "SELECT * FROM orders",
    "append_replay": "SELECT * FROM orders",
    "compact_rows": "SELECT * FROM part",
    # Four appends to four buckets; each bucket ends as one file, and the four
    # folders of each bucket that only old versions named are gone.
    "compaction_report": """
SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(16 AS BIGINT) AS files_before,
       CAST(4 AS BIGINT) AS files_after, CAST(16 AS BIGINT) AS folders_deleted,
       CAST(1 AS BIGINT) AS versions_left
FROM part""",
    "compact_packed": """
SELECT count(*) AS rows_after, CAST(sum(o_orderkey) AS BIGINT) AS keys_after, CAST(10 AS BIGINT) AS files_before,
       CAST(4 AS BIGINT) AS files_after, CAST(2 AS BIGINT) AS folders_kept, true AS only_small_rewritten
FROM orders""",
    "table_detail_row": "SELECT count(*) AS rows, true AS same_files, true AS same_bytes FROM orders",
    "file_manifest": _MERGED_ORDERS,
    "stream_pipeline_avro": _STATE,
    "stream_pipeline_json": _STATE,
    "stream_any_batches": _STATE,
    "stream_old_files": _STATE,
    "merge_runs_state": _STATE,
    "merge_any_order": _STATE,
    "stream_bootstrap_replay": _STATE,
    "stream_replay_idempotent": _STATE,
    "stream_staged_rows": _FLAT,
    "raw_landing": _LANDED,
    "raw_landing_resent": _LANDED,
    "pipeline_history": f"""
WITH {_CL},
span AS (SELECT min(event_id) AS low, max(event_id) + 1 - min(event_id) AS width FROM events),
cuts AS (SELECT i AS batch, low + width * i // 4 AS start, low + width * (i + 1) // 4 AS stop
         FROM span, range(4) r(i)),
newest AS (
  SELECT batch, op, row_number() OVER (PARTITION BY batch, id
                                       ORDER BY ts DESC, event_id DESC) AS rn
  FROM cl JOIN cuts ON event_id >= start AND event_id < stop
)
SELECT batch AS version, CASE WHEN batch = 0 THEN 'CREATE' ELSE 'MERGE' END AS operation,
       count(*) FILTER (WHERE op <> 'd') AS upserts,
       CASE WHEN batch = 0 THEN 0 ELSE count(*) FILTER (WHERE op = 'd') END AS deletes
FROM newest WHERE rn = 1 GROUP BY batch""",
    "multi_table_pipeline": f"""
WITH {_CL}
SELECT table_name, id, name, weight, description, revision, op FROM (
  SELECT cl.*, name AS table_name,
         row_number() OVER (PARTITION BY name, id ORDER BY ts DESC, event_id DESC) AS rn
  FROM cl
) WHERE rn = 1 AND op <> 'd'""",
}
