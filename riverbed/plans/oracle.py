"""DuckDB SQL equivalents of ``riverbed.plans.queries`` (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's tables, with the
same derivation rule for the change stream (see ``riverbed.sources.tables``)."""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, {TS})"


# Change records derived from events (one mod per record).
CHG = """
chg AS (
  SELECT event_id, user_id, value, props, event_type, ts,
    date_trunc('hour', ts) AS commit_ts,
    CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS commit_seconds,
    0 AS commit_nanos,
    lpad(CAST(event_id // 4 AS VARCHAR), 12, '0') AS server_txn_id,
    lpad(CAST(event_id % 4 AS VARCHAR), 8, '0') AS record_sequence,
    CASE WHEN event_type IN ('click', 'view') THEN 'activity'
         WHEN event_type = 'error' AND event_id % 7 = 0 THEN 'unmapped'
         ELSE 'account' END AS table_name,
    CASE WHEN event_type = 'signup' THEN 'INSERT' WHEN event_type = 'error' THEN 'DELETE'
         ELSE 'UPDATE' END AS mod_type,
    CASE WHEN event_id % 10 = 0 THEN 'txBy=fwd' WHEN event_id % 10 = 1 THEN NULL ELSE '' END AS txn_tag,
    '{"UserId":"' || CAST(user_id AS VARCHAR) || '"}' AS keys_json,
    '{}' AS old_values_json,
    CASE WHEN event_type = 'error' THEN '{}'
         ELSE '{"value":' || CAST(value AS VARCHAR) || ',"props":' || props
              || ',"shard_id":"shard' || CAST(user_id % 4 AS VARCHAR) || '"}' END AS new_values_json,
    CASE WHEN event_type = 'error' THEN NULL ELSE 'shard' || CAST(user_id % 4 AS VARCHAR) END AS shard_id,
    CAST(4 AS BIGINT) AS num_records_in_txn
  FROM events
),
fwd AS (SELECT * FROM chg WHERE NOT starts_with(coalesce(txn_tag, ''), 'txBy='))
"""


def with_chg(body: str) -> str:
    return "WITH " + CHG.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["s1_scan_range"] = with_chg(f"""
SELECT server_txn_id, record_sequence, table_name, {ts_text('commit_ts')} AS commit_ts FROM chg
WHERE commit_ts >= TIMESTAMP '2024-01-05 00:00:00' AND commit_ts <= TIMESTAMP '2024-01-20 00:00:00'
""")

ORACLE["p1_filter_forward"] = with_chg("SELECT server_txn_id, record_sequence, txn_tag FROM fwd")

ORACLE["p1_filter_none"] = with_chg("SELECT server_txn_id, record_sequence, txn_tag FROM chg")

ORACLE["p2_explode_mods"] = """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS server_txn_id,
  '{"l_orderkey":"' || CAST(l_orderkey AS VARCHAR) || '","l_linenumber":"' || CAST(l_linenumber AS VARCHAR) || '"}' AS keys_json,
  '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_returnflag":"' || l_returnflag || '"}' AS new_values_json,
  CASE WHEN o_orderstatus = 'F' THEN 'UPDATE' ELSE 'INSERT' END AS mod_type,
  count(*) OVER (PARTITION BY o_orderkey) AS num_records_in_txn
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
"""

ORACLE["p3_parse_buffer"] = with_chg(f"""
SELECT table_name, keys_json, new_values_json, mod_type, {ts_text('commit_ts')} AS commit_ts,
  commit_nanos, server_txn_id, record_sequence FROM chg
""")

ORACLE["p5_row_image"] = with_chg("""
SELECT server_txn_id, record_sequence, CAST(user_id AS VARCHAR) AS user_key,
  CASE WHEN mod_type = 'DELETE' THEN NULL ELSE CAST(value AS VARCHAR) END AS value_text,
  shard_id, CASE WHEN mod_type = 'DELETE' THEN 1 ELSE 4 END AS n_fields
FROM fwd
""")

ORACLE["p6_primary_key"] = with_chg("SELECT server_txn_id, record_sequence, user_id AS pk_user_id FROM fwd")

ORACLE["p7_change_key"] = with_chg("""
SELECT server_txn_id, record_sequence,
  table_name || '_' || keys_json ||
  CASE WHEN table_name = 'unmapped' THEN '_skip' WHEN shard_id IS NULL THEN '' ELSE '_' || shard_id END AS change_key
FROM fwd
""")

ORACLE["p8_validate_shard"] = with_chg("""
SELECT server_txn_id, record_sequence,
  CASE WHEN table_name = 'activity' THEN shard_id || '/a' ELSE shard_id END AS shard,
  CASE WHEN shard_id IS NULL THEN 'shard id is null'
       WHEN table_name = 'activity' THEN 'shard id contains ''/''' END AS shard_error
FROM fwd
""")

ORACLE["p9_replicable"] = with_chg("""
SELECT server_txn_id, record_sequence, table_name,
  CASE WHEN table_name = 'unmapped' THEN 'table not in session' END AS drop_reason
FROM fwd
""")

# ----------------------------------------------------------------------------- typed X*
TYPED = """
WITH typ AS (
  SELECT event_id, user_id, value, props, event_type, ts,
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS server_txn_id
  FROM events)
"""

ORACLE["x1_to_boolean"] = TYPED + """
SELECT server_txn_id, value > 100 AS b, false AS s_as_bool, CAST(NULL AS BOOLEAN) AS nul FROM typ
"""

ORACLE["x2_to_long"] = TYPED + """
SELECT server_txn_id, event_id AS id, CAST(trunc(value) AS BIGINT) AS f_as_long, CAST(0 AS BIGINT) AS s_as_long FROM typ
"""

ORACLE["x3_to_double"] = TYPED + """
SELECT server_txn_id, value AS f, value AS n, 0.0::DOUBLE AS s_as_double FROM typ
"""

ORACLE["x4_to_string"] = TYPED + """
SELECT server_txn_id, event_type AS s, CAST(value AS VARCHAR) AS f,
  CASE WHEN value > 100 THEN 'true' ELSE 'false' END AS b, 'it''s ' || event_type AS q FROM typ
"""

ORACLE["x5_to_bytes"] = TYPED + "SELECT server_txn_id, hex(event_type) AS by_hex FROM typ"

ORACLE["x6_to_timestamp"] = TYPED + f"""
SELECT server_txn_id, {ts_text('ts')} AS t, CAST(strftime(ts, '%f') AS INTEGER) * 1000 AS t_nanos,
  CAST(NULL AS VARCHAR) AS d_as_ts FROM typ
"""

ORACLE["x7_to_date"] = TYPED + """
SELECT server_txn_id, strftime(ts, '%Y-%m-%d') AS d, CAST(NULL AS VARCHAR) AS f_as_date FROM typ
"""

ORACLE["x8_to_numeric"] = TYPED + """
SELECT server_txn_id, CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,9)) AS VARCHAR) AS n,
  CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,9)) AS VARCHAR) AS f FROM typ
"""

ORACLE["x8_wide_numeric"] = """
WITH written AS (
  SELECT event_id, CASE WHEN event_id % 2 = 1 THEN '-' ELSE '' END AS sign,
    CASE WHEN event_id % 35 = 0 THEN repeat('9', 55)
         ELSE '7' || lpad(CAST(event_id AS VARCHAR), 18, '0') || lpad(CAST(user_id AS VARCHAR), 18, '0') || lpad(CAST(event_id AS VARCHAR), 18, '0') END AS w,
    CASE WHEN event_id % 5 = 0 THEN '999999999500'
         ELSE lpad(CAST(user_id % 1000000000 AS VARCHAR), 9, '0') || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') END AS p,
    CASE WHEN event_id % 3 = 0 THEN 3 ELSE 0 END AS e
  FROM events),
moved AS (SELECT event_id, sign, w || substr(p, 1, e) AS w, rpad(substr(p, e + 1), 12, '0') AS p FROM written),
numbers AS (
  SELECT event_id, sign, CAST(left(w, length(w) - 36) AS HUGEINT) AS hi, CAST(right(w, 36) AS HUGEINT) AS lo,
    (CAST(p AS BIGINT) + 500) // 1000 AS nine
  FROM moved),
carried AS (
  SELECT event_id, sign, hi, lo + (nine = 1000000000)::INT AS lo, nine % 1000000000 AS nine FROM numbers),
whole AS (
  SELECT event_id, sign, hi + (lo = CAST('1' || repeat('0', 36) AS HUGEINT))::INT AS hi, lo, nine FROM carried)
SELECT event_id,
  sign || CAST(CAST(hi AS HUGEINT) AS VARCHAR) || CASE WHEN lo = CAST('1' || repeat('0', 36) AS HUGEINT) THEN repeat('0', 36) ELSE lpad(CAST(lo AS VARCHAR), 36, '0') END
    || '.' || lpad(CAST(nine AS VARCHAR), 9, '0') AS n, n AS s
FROM whole
"""

ORACLE["x9_presence"] = TYPED + """
SELECT server_txn_id, true AS has_nul, true AS nul_is_null, false AS has_zz, false AS s_is_null FROM typ
"""

# ----------------------------------------------------------------------------- sharding A*
ORACLE["a1_shard_mod"] = with_chg("""
SELECT server_txn_id, record_sequence, user_id, CAST(user_id % 7 AS VARCHAR) AS shard FROM fwd
""")

ASOF_SHARD = """,
dels AS (SELECT * FROM fwd WHERE mod_type = 'DELETE'),
vers AS (SELECT * FROM fwd WHERE mod_type <> 'DELETE' AND table_name IN ('account', 'activity')),
cand AS (
  SELECT d.server_txn_id, d.record_sequence, v.shard_id,
    row_number() OVER (PARTITION BY d.server_txn_id, d.record_sequence
                       ORDER BY v.commit_seconds DESC, v.commit_nanos DESC, v.server_txn_id DESC,
                                v.record_sequence DESC) AS rn
  FROM dels d JOIN vers v ON v.table_name = d.table_name AND v.keys_json = d.keys_json
   AND (v.commit_seconds < d.commit_seconds - 1
        OR (v.commit_seconds = d.commit_seconds - 1 AND v.commit_nanos <= d.commit_nanos))),
asof_res AS (
  SELECT d.server_txn_id, d.record_sequence, c.shard_id AS shard
  FROM dels d LEFT JOIN cand c ON c.server_txn_id = d.server_txn_id AND c.record_sequence = d.record_sequence
   AND c.rn = 1)
"""

ORACLE["a2_shard_column"] = with_chg(ASOF_SHARD + """
SELECT server_txn_id, record_sequence, shard_id AS shard, CAST(NULL AS VARCHAR) AS drop_reason
FROM fwd WHERE mod_type <> 'DELETE'
UNION ALL
SELECT server_txn_id, record_sequence, shard,
  CASE WHEN shard IS NULL THEN 'no row version before delete' END AS drop_reason
FROM asof_res
""")

ORACLE["a3_shard_image"] = with_chg("""
SELECT server_txn_id, record_sequence,
  CASE WHEN table_name = 'unmapped' THEN 'skip' ELSE shard_id END AS shard,
  CASE WHEN table_name <> 'unmapped' AND shard_id IS NULL THEN 'shard column not in record' END AS shard_error
FROM fwd
""")

# deletes of mapped tables take the shard of the version in force a second before
IMAGE_ASOF = ASOF_SHARD + """,
imgd AS (
  SELECT f.*, CASE WHEN f.table_name = 'unmapped' THEN 'skip' WHEN f.mod_type = 'DELETE' THEN a.shard ELSE f.shard_id END AS shard,
    CASE WHEN f.table_name <> 'unmapped' AND f.mod_type = 'DELETE' AND a.shard IS NULL THEN 'no row version before delete' END AS shard_error
  FROM fwd f LEFT JOIN asof_res a ON a.server_txn_id = f.server_txn_id AND a.record_sequence = f.record_sequence)
"""

ORACLE["a6_image_deletes"] = with_chg(IMAGE_ASOF + "SELECT server_txn_id, record_sequence, shard, shard_error FROM imgd")

ORACLE["a6_stored_versions"] = with_chg(IMAGE_ASOF + """
SELECT server_txn_id, record_sequence, shard, shard_error FROM imgd WHERE commit_ts >= TIMESTAMP '2024-01-15 00:00:00'
""")

ORACLE["a4_shard_constant"] = with_chg("""
SELECT server_txn_id, record_sequence,
  (SELECT 'shard' || lpad(CAST(min(s_suppkey) AS VARCHAR), 5, '0') FROM supplier) AS shard
FROM fwd
""")

# ----------------------------------------------------------------------------- joins J*
ORACLE["j1_map_tables"] = with_chg("""
SELECT server_txn_id, record_sequence,
  CASE table_name WHEN 'account' THEN 't1' WHEN 'activity' THEN 't2' END AS table_id,
  CASE table_name WHEN 'account' THEN 'accounts' WHEN 'activity' THEN 'activity_log' END AS src_table
FROM fwd
""")

SHADOW = """,
shadow AS (
  SELECT c_custkey AS user_id,
    to_timestamp(1704067200 + (c_custkey % 30) * 86400 + c_nationkey * 3600)::TIMESTAMP AS processed_commit_ts
  FROM customer)
"""

ORACLE["j3_shadow_filter"] = with_chg(SHADOW + """
SELECT f.server_txn_id, f.record_sequence,
  (s.processed_commit_ts IS NULL OR s.processed_commit_ts <= f.commit_ts) AS applied
FROM fwd f LEFT JOIN shadow s ON s.user_id = f.user_id
WHERE f.table_name = 'account'
""")

ORACLE["j4_asof_lookup"] = with_chg(""",
vers AS (SELECT * FROM fwd WHERE mod_type <> 'DELETE'),
cand AS (
  SELECT p.server_txn_id, p.record_sequence, CAST(v.value AS VARCHAR) AS prior_value,
    row_number() OVER (PARTITION BY p.server_txn_id, p.record_sequence
                       ORDER BY v.commit_seconds DESC, v.commit_nanos DESC, v.server_txn_id DESC,
                                v.record_sequence DESC) AS rn
  FROM fwd p JOIN vers v ON v.table_name = p.table_name AND v.keys_json = p.keys_json
   AND (v.commit_seconds < p.commit_seconds - 1
        OR (v.commit_seconds = p.commit_seconds - 1 AND v.commit_nanos <= p.commit_nanos)))
SELECT p.server_txn_id, p.record_sequence, c.prior_value
FROM fwd p LEFT JOIN cand c ON c.server_txn_id = p.server_txn_id AND c.record_sequence = p.record_sequence
 AND c.rn = 1
""")

ORACLE["j5_tables_without_shadow"] = with_chg(""",
names AS (SELECT DISTINCT table_name FROM chg
          UNION ALL SELECT DISTINCT 'shadow_' || table_name FROM chg WHERE table_name = 'account')
SELECT table_name FROM names n
WHERE NOT starts_with(table_name, 'shadow_')
  AND NOT EXISTS (SELECT 1 FROM names s WHERE s.table_name = 'shadow_' || n.table_name)
""")

ORACLE["j6_seen_ids"] = """
SELECT event_id, user_id IN (SELECT user_id FROM events WHERE event_type = 'signup') AS seen FROM events
"""

SUPPLIER_PARTS = """
parts AS (
  SELECT 'shard' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS logicalShardId,
    row_number() OVER (ORDER BY 'shard' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0')) - 1 AS partition
  FROM (SELECT DISTINCT s_suppkey FROM supplier))
"""

ORACLE["j8_kafka_partition"] = with_chg(", " + SUPPLIER_PARTS.strip() + """
SELECT f.server_txn_id, f.record_sequence, 'shard' || lpad(CAST(f.user_id % 100 + 1 AS VARCHAR), 5, '0') AS shard,
  p.partition
FROM fwd f LEFT JOIN parts p ON p.logicalShardId = 'shard' || lpad(CAST(f.user_id % 100 + 1 AS VARCHAR), 5, '0')
""")

# ----------------------------------------------------------------------------- G* / O*
LATEST = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY table_name, keys_json
     ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn
  FROM fwd)
"""

ORACLE["g1_latest_per_key"] = with_chg(LATEST + """
SELECT table_name, keys_json, server_txn_id, record_sequence, mod_type FROM ranked WHERE rn = 1
""")

ORACLE["g1_repeated_keys"] = """
WITH m AS (
  SELECT o_orderkey, '{"l_orderkey":"' || CAST(l_orderkey AS VARCHAR) || '"}' AS keys_json,
    '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_returnflag":"' || l_returnflag || '"}' AS new_values_json,
    row_number() OVER (PARTITION BY o_orderkey ORDER BY '{"l_orderkey":"' || CAST(l_orderkey AS VARCHAR) || '","l_linenumber":"' || CAST(l_linenumber AS VARCHAR) || '"}',
      '{"l_quantity":' || CAST(l_quantity AS VARCHAR) || ',"l_returnflag":"' || l_returnflag || '"}', l_linenumber) AS place,
    count(*) OVER (PARTITION BY o_orderkey) AS n
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT keys_json, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS server_txn_id, CAST(place - 1 AS INTEGER) AS mod_position, new_values_json
FROM m WHERE place = n
"""

ORACLE["g1_latest_reference_mode"] = with_chg(""",
ranked AS (
  SELECT *, CAST(user_id % 5 AS VARCHAR) AS shard, row_number() OVER (PARTITION BY user_id % 5, user_id
     ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn
  FROM fwd)
SELECT shard, user_id, server_txn_id, record_sequence, table_name FROM ranked WHERE rn = 1
""")

IMAGE_SHARD = """,
img AS (
  SELECT *, CASE WHEN table_name = 'unmapped' THEN 'skip' ELSE coalesce(shard_id, 'unknown') END AS shard
  FROM fwd)
"""
P_TS = "TIMESTAMP '2024-02-01 00:00:00'"

ORACLE["g2_release_lag"] = with_chg(IMAGE_SHARD + f"""
SELECT shard, {ts_text('min(commit_ts)')} AS earliest_commit_ts,
  CAST((epoch_us({P_TS}) - epoch_us(min(commit_ts))) / 1000 AS BIGINT) AS lag_ms
FROM img GROUP BY shard
""")

ORACLE["g3_batch_lag"] = with_chg(IMAGE_SHARD + f"""
SELECT shard, {ts_text('min(commit_ts)')} AS first_commit_ts,
  date_diff('second', min(commit_ts), {P_TS}) AS lag_seconds
FROM img GROUP BY shard
""")

ORACLE["g4_record_counts"] = with_chg(IMAGE_SHARD + """
SELECT shard, count(*) AS records, 'shard' AS scope FROM img GROUP BY shard
UNION ALL SELECT NULL, count(*), 'all' FROM img
""")

ORACLE["g5_lag_distribution"] = with_chg(IMAGE_SHARD + f""",
lags AS (SELECT shard, CAST(floor((epoch_us({P_TS}) - epoch_us(commit_ts)) / 1000) AS BIGINT) AS lag_ms FROM img)
SELECT shard, count(lag_ms) AS n, CAST(sum(lag_ms) AS BIGINT) AS sum_ms, min(lag_ms) AS min_ms,
  max(lag_ms) AS max_ms, 'shard' AS scope FROM lags GROUP BY shard
UNION ALL
SELECT NULL, count(lag_ms), CAST(sum(lag_ms) AS BIGINT), min(lag_ms), max(lag_ms), 'all' FROM lags
""")

ORACLE["g5_lag_meter"] = f"SELECT *, true AS p50_holds, true AS p99_holds FROM ({ORACLE['g5_lag_distribution']})"

ORACLE["g7_min_file_start"] = with_chg(IMAGE_SHARD + f"""
SELECT {ts_text("min(time_bucket(INTERVAL 6 hour, commit_ts))")} AS min_start FROM img
""")

ORACLE["g8_advance_progress"] = with_chg(IMAGE_SHARD + f""",
cur AS (SELECT shard, min(time_bucket(INTERVAL 6 hour, commit_ts)) AS t FROM img GROUP BY shard),
upd AS (SELECT shard, max(time_bucket(INTERVAL 6 hour, commit_ts)) AS t FROM img WHERE shard <> 'shard0'
        GROUP BY shard)
SELECT 'run-1' AS run_id, coalesce(c.shard, u.shard) AS shard,
  {ts_text('greatest(c.t, coalesce(u.t, c.t))')} AS created_upto
FROM cur c FULL OUTER JOIN upd u ON c.shard = u.shard
""")

ORACLE["o1_shard_order"] = with_chg(IMAGE_SHARD + """
SELECT shard, server_txn_id, record_sequence,
  row_number() OVER (PARTITION BY shard ORDER BY commit_seconds, commit_nanos, server_txn_id, record_sequence)
    AS position
FROM img
""")

ORACLE["o3_partition_numbers"] = "WITH " + SUPPLIER_PARTS.strip() + "\nSELECT logicalShardId, partition FROM parts"

# ----------------------------------------------------------------------------- DML F*
def _typed_vals(tz: str, dialect: str, q_expr: str = "'''' || replace('it''s ' || event_type, '''', '''''') || ''''") -> str:
    if dialect == "mysql":
        t = f"' CONVERT_TZ(''' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || ''',''+00:00'',''{tz}'')'"
    else:
        t = (f"' TO_CHAR((TIMESTAMP ''' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || ''' AT TIME ZONE ''+00:00'' "
             f"AT TIME ZONE ''{tz}''), ''YYYY-MM-DD HH24:MI:SS'')'")
    return f"""
WITH v AS (
  SELECT event_id, event_type, lpad(CAST(event_id AS VARCHAR), 12, '0') AS server_txn_id,
    CAST(event_id AS VARCHAR) AS v_id, CAST(value AS VARCHAR) AS v_f,
    CASE WHEN value > 100 THEN 'true' ELSE 'false' END AS v_b,
    '''' || event_type || '''' AS v_s,
    '''' || event_type || ',k' || CAST(user_id % 3 AS VARCHAR) || '''' AS v_arr,
    'X''' || lower(hex(event_type)) || '''' AS v_hx,
    '''' || event_type || '''' AS v_by,
    {t} AS v_t,
    '''' || strftime(ts, '%Y-%m-%d') || '''' AS v_d,
    '''' || json(props)::VARCHAR || '''' AS v_j,
    {q_expr} AS v_q,
    'NULL' AS v_nul, CAST(value AS VARCHAR) AS v_n
  FROM events)
"""


_TCOLS = ["f", "b", "s", "arr", "hx", "by", "t", "d", "j", "q", "nul", "n"]


def _typed_dml(dialect: str, tz: str, q_expr: str | None = None) -> str:
    head = _typed_vals(tz, dialect) if q_expr is None else _typed_vals(tz, dialect, q_expr)
    cols = ",".join(_TCOLS)
    vals = " || ',' || ".join(f"v_{c}" for c in _TCOLS)
    if dialect == "mysql":
        sets = " || ',' || ".join(f"' {c} = ' || v_{c}" for c in _TCOLS)
        ups = (f"'INSERT INTO typed_src(id,{cols}) VALUES (' || v_id || ',' || {vals} || ') ON DUPLICATE KEY UPDATE ' "
               f"|| {sets}")
        dele = "'DELETE FROM typed_src WHERE  id = ' || v_id"
    else:
        sets = ",".join(f" {c} = EXCLUDED.{c}" for c in _TCOLS)
        ups = (f"'INSERT INTO typed_src(id,{cols}) VALUES (' || v_id || ',' || {vals} || ') ON CONFLICT(id) "
               f"DO UPDATE SET{sets}'")
        dele = "'DELETE FROM typed_src WHERE id = ' || v_id"
    return head + f"SELECT server_txn_id, CASE WHEN event_type = 'error' THEN {dele} ELSE {ups} END AS dml FROM v"


ORACLE["f_dml_mysql_typed"] = _typed_dml("mysql", "+05:30")
ORACLE["f_dml_postgres_typed"] = _typed_dml("postgresql", "+05:30")
ORACLE["f7_escape_backslash"] = _typed_dml("mysql", "+05:30", "'''it\\\\''''s ' || event_type || ''''")

ORACLE["f14_pk_only"] = """
SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS server_txn_id, d.dialect,
  CASE WHEN event_type = 'error' AND d.dialect = 'mysql' THEN 'DELETE FROM typed_keys WHERE  id = ' || event_id
       WHEN event_type = 'error' THEN 'DELETE FROM typed_keys WHERE id = ' || event_id
       WHEN d.dialect = 'mysql' THEN 'INSERT INTO typed_keys(id) VALUES (' || event_id || ') '
       ELSE 'INSERT INTO typed_keys(id) VALUES (' || event_id || ')' END AS dml
FROM events, (VALUES ('mysql'), ('postgresql')) AS d(dialect)
"""


def _events_dml(dialect: str) -> str:
    acc_vals = "CAST(user_id AS VARCHAR) || ',' || CAST(value AS VARCHAR) || ',''' || json(props)::VARCHAR || ''''"
    act_vals = "CAST(user_id AS VARCHAR) || ',' || CAST(value AS VARCHAR) || ',''' || json(props)::VARCHAR || ''''"
    if dialect == "mysql":
        acc = (f"'INSERT INTO accounts(user_id,balance,attrs) VALUES (' || {acc_vals} || ') ON DUPLICATE KEY UPDATE "
               f" balance = ' || CAST(value AS VARCHAR) || ', attrs = ''' || json(props)::VARCHAR || ''''")
        act = (f"'INSERT INTO activity_log(user_id,amount,props) VALUES (' || {act_vals} || ') ON DUPLICATE KEY UPDATE "
               f" amount = ' || CAST(value AS VARCHAR) || ', props = ''' || json(props)::VARCHAR || ''''")
        dele = "'DELETE FROM accounts WHERE  user_id = ' || CAST(user_id AS VARCHAR)"
    else:
        acc = (f"'INSERT INTO accounts(user_id,balance,attrs) VALUES (' || {acc_vals} || ') ON CONFLICT(user_id) "
               f"DO UPDATE SET balance = EXCLUDED.balance, attrs = EXCLUDED.attrs'")
        act = (f"'INSERT INTO activity_log(user_id,amount,props) VALUES (' || {act_vals} || ') ON CONFLICT(user_id) "
               f"DO UPDATE SET amount = EXCLUDED.amount, props = EXCLUDED.props'")
        dele = "'DELETE FROM accounts WHERE user_id = ' || CAST(user_id AS VARCHAR)"
    return (f"CASE WHEN table_name = 'unmapped' THEN '' WHEN mod_type = 'DELETE' THEN {dele} "
            f"WHEN table_name = 'account' THEN {acc} ELSE {act} END")


ORACLE["f12_mysql_events"] = with_chg(f"SELECT server_txn_id, record_sequence, {_events_dml('mysql')} AS dml FROM fwd")
ORACLE["f13_postgres_events"] = with_chg(
    f"SELECT server_txn_id, record_sequence, {_events_dml('postgresql')} AS dml FROM fwd")

ORACLE["f17_connection_urls"] = """
WITH s AS (
  SELECT 'shard' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS logicalShardId,
    'db-' || CAST(s_nationkey AS VARCHAR) || '.internal' AS host,
    CASE WHEN s_nationkey % 2 = 0 THEN '3306' ELSE '5432' END AS port,
    'db' || CAST(s_nationkey AS VARCHAR) AS dbName
  FROM supplier)
SELECT logicalShardId, 'replicator' AS "user",
  'jdbc:mysql://' || host || ':' || port || '/' || dbName || '?rewriteBatchedStatements=true' AS jdbc_url,
  'mysql' AS source_type FROM s
UNION ALL
SELECT logicalShardId, 'replicator', 'jdbc:postgresql://' || host || ':' || port || '/' || dbName
  || '?ssl=true&sslmode=verify-ca', 'postgresql' FROM s
"""

APPLY = """,
acc AS (SELECT * FROM fwd WHERE table_name = 'account'),
lat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn
        FROM acc) WHERE rn = 1),
dels AS (SELECT DISTINCT user_id FROM acc WHERE mod_type = 'DELETE'),
tgt AS (SELECT c_custkey AS user_id, c_acctbal AS balance, c_mktsegment AS note FROM customer)
"""

ORACLE["f18_apply_row"] = with_chg(APPLY + """
SELECT coalesce(t.user_id, l.user_id) AS user_id,
  CASE WHEN l.user_id IS NULL THEN t.balance ELSE l.value END AS balance,
  CASE WHEN l.user_id IS NULL THEN NULL ELSE json(l.props)::VARCHAR END AS attrs,
  t.note AS note
FROM tgt t FULL OUTER JOIN lat l ON t.user_id = l.user_id
WHERE l.user_id IS NULL OR l.mod_type <> 'DELETE'
""")

ORACLE["f18_apply_column"] = with_chg(APPLY + """
SELECT coalesce(t.user_id, l.user_id) AS user_id,
  CASE WHEN l.user_id IS NULL THEN t.balance ELSE l.value END AS balance,
  CASE WHEN l.user_id IS NULL THEN NULL ELSE json(l.props)::VARCHAR END AS attrs,
  CASE WHEN l.user_id IS NOT NULL AND d.user_id IS NOT NULL THEN NULL ELSE t.note END AS note
FROM tgt t FULL OUTER JOIN lat l ON t.user_id = l.user_id LEFT JOIN dels d ON d.user_id = l.user_id
WHERE l.user_id IS NULL OR l.mod_type <> 'DELETE'
""")

ORACLE["f18_stored_target"] = ORACLE["f18_apply_column"]

ORACLE["q6_table_apply"] = with_chg(APPLY + """,
act AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn
        FROM fwd WHERE table_name = 'activity') WHERE rn = 1),
tga AS (SELECT c_custkey AS user_id, c_acctbal AS amount FROM customer WHERE c_nationkey % 2 = 0)
SELECT 'accounts' AS src_table, coalesce(t.user_id, l.user_id) AS user_id,
  CASE WHEN l.user_id IS NULL THEN t.balance ELSE l.value END AS amount,
  CASE WHEN l.user_id IS NULL THEN NULL ELSE json(l.props)::VARCHAR END AS doc, t.note AS note
FROM tgt t FULL OUTER JOIN lat l ON t.user_id = l.user_id
WHERE l.user_id IS NULL OR l.mod_type <> 'DELETE'
UNION ALL
SELECT 'activity_log', coalesce(t.user_id, l.user_id), CASE WHEN l.user_id IS NULL THEN t.amount ELSE l.value END,
  CASE WHEN l.user_id IS NULL THEN NULL ELSE json(l.props)::VARCHAR END, CAST(NULL AS VARCHAR)
FROM tga t FULL OUTER JOIN act l ON t.user_id = l.user_id
WHERE l.user_id IS NULL OR l.mod_type <> 'DELETE'
""")

# ----------------------------------------------------------------------------- W*
ORACLE["w8_window_start"] = f"""
SELECT event_id, {ts_text("time_bucket(INTERVAL 10 second, ts)")} AS w10s,
  {ts_text("time_bucket(INTERVAL 5 minute, ts)")} AS w5m, {ts_text("time_bucket(INTERVAL 2 hour, ts)")} AS w2h
FROM events
"""

ORACLE["w9_guard_twin"] = with_chg(""",
arr AS (SELECT *, (event_id % 10) * 1000000 + event_id AS arrival,
          commit_seconds * 1000000000 + commit_nanos AS cns FROM fwd),
pm AS (SELECT *, max(cns) OVER (PARTITION BY table_name, keys_json ORDER BY arrival
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM arr)
SELECT server_txn_id, record_sequence, (prior IS NULL OR cns >= prior) AS kept FROM pm
""")

ORACLE["w11_dedup_ids"] = f"""
SELECT user_id AS id, {ts_text('min(ts)')} AS created_at FROM events
WHERE ts >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY
GROUP BY user_id
"""

# ----------------------------------------------------------------------------- sinks K*
MSG_JSON = """'{"commitTimestamp":{"seconds":' || CAST(commit_seconds AS VARCHAR) || ',"nanos":'
  || CAST(commit_nanos AS VARCHAR) || '},"serverTransactionId":' || to_json(server_txn_id)::VARCHAR
  || ',"recordSequence":' || to_json(record_sequence)::VARCHAR || ',"tableName":' || to_json(table_name)::VARCHAR
  || ',"mods":[{"keysJson":' || to_json(keys_json)::VARCHAR || ',"oldValuesJson":' || to_json(old_values_json)::VARCHAR
  || ',"newValuesJson":' || to_json(new_values_json)::VARCHAR || '}],"modType":' || to_json(mod_type)::VARCHAR
  || ',"numberOfRecordsInTransaction":' || CAST(num_records_in_txn AS VARCHAR) || ',"transactionTag":'
  || CASE WHEN txn_tag IS NULL THEN 'null' ELSE to_json(txn_tag)::VARCHAR END || '}'"""

ORACLE["k1_kafka_frame"] = with_chg(", " + SUPPLIER_PARTS.strip() + f""",
sh AS (SELECT *, 'shard' || lpad(CAST(user_id % 100 + 1 AS VARCHAR), 5, '0') AS shard FROM fwd)
SELECT 'changes' AS topic, CAST(p.partition AS INTEGER) AS partition, sh.shard AS key, {MSG_JSON} AS value,
  server_txn_id, record_sequence
FROM sh LEFT JOIN parts p ON p.logicalShardId = sh.shard
""")

ORACLE["k2_ordered_topic"] = with_chg(f""",
sh AS (SELECT *, 'shard' || lpad(CAST(user_id % 100 + 1 AS VARCHAR), 5, '0') AS shard FROM fwd)
SELECT shard AS ordering_key, shard AS shard_attr, {MSG_JSON} AS data, server_txn_id, record_sequence FROM sh
""")

TOPIC = f""",
sh AS (SELECT *, 'shard' || lpad(CAST(user_id % 100 + 1 AS VARCHAR), 5, '0') AS shard FROM fwd),
topic AS (
  SELECT shard, {MSG_JSON} AS data,
    row_number() OVER (PARTITION BY shard ORDER BY commit_seconds, commit_nanos, server_txn_id, record_sequence) AS position
  FROM sh)"""

ORACLE["k2_topic_messages"] = with_chg(TOPIC + """
SELECT shard AS ordering_key, position, shard AS shard_attr, data FROM topic
""")

ORACLE["s3_capped_pull"] = with_chg(TOPIC + """
SELECT shard, data AS value FROM topic WHERE position <= 100
""")

ORACLE["k5_shadow_upsert"] = with_chg(SHADOW + f""",
applied AS (
  SELECT f.user_id, f.commit_ts FROM fwd f LEFT JOIN shadow s ON s.user_id = f.user_id
  WHERE f.table_name = 'account' AND (s.processed_commit_ts IS NULL OR s.processed_commit_ts <= f.commit_ts)),
u AS (SELECT user_id, processed_commit_ts AS ts FROM shadow UNION ALL SELECT user_id, commit_ts FROM applied)
SELECT 'account' AS table_name, user_id AS UserId, {ts_text('max(ts)')} AS processed_commit_ts FROM u GROUP BY user_id
""")

ORACLE["k8_progress_init"] = """
SELECT 'run-1' AS run_id, 'shard' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS shard,
  '1970-01-01 12:00:00.000000' AS created_upto FROM supplier
"""

ORACLE["k9_seen_insert"] = f"""
SELECT user_id AS id, {ts_text('min(ts)')} AS created_at FROM events GROUP BY user_id
"""

ORACLE["k12_windowed_export"] = with_chg(IMAGE_SHARD + f"""
SELECT shard, {ts_text("time_bucket(INTERVAL 1 hour, commit_ts)")} AS window_start, server_txn_id, record_sequence,
  {MSG_JSON} AS record
FROM img
""")

# ----------------------------------------------------------------------------- G9 + jobs Q*
ORACLE["g9_statement_batches"] = with_chg(IMAGE_SHARD + f""",
st AS (SELECT shard, commit_seconds, commit_nanos, server_txn_id, record_sequence,
         {_events_dml('mysql')} AS dml FROM img),
pos AS (SELECT *, row_number() OVER (PARTITION BY shard
          ORDER BY commit_seconds, commit_nanos, server_txn_id, record_sequence) AS position
        FROM st WHERE dml <> '')
SELECT shard, (position - 1) // 50 AS batch_no, min(position) AS first_position, count(*) AS n_statements,
  string_agg(dml, chr(10) ORDER BY position) AS batch_text
FROM pos GROUP BY shard, (position - 1) // 50
""")

def _q1(partition: str) -> str:
    return with_chg(f""",
lat AS (SELECT *, CAST(user_id % 500 AS VARCHAR) AS shard, row_number() OVER (PARTITION BY {partition}
          ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn
        FROM fwd)
SELECT shard, user_id, server_txn_id, record_sequence, {_events_dml('mysql')} AS dml
FROM lat WHERE rn = 1 AND table_name <> 'unmapped'
""")


ORACLE["q1_direct_replication"] = _q1("table_name, keys_json")
ORACLE["q1_reference_mode"] = _q1("user_id")

SHADOWED = IMAGE_ASOF + SHADOW + """,
tested AS (
  SELECT f.*, (s.processed_commit_ts IS NULL OR s.processed_commit_ts <= f.commit_ts) AS fresh
  FROM imgd f LEFT JOIN (SELECT user_id AS s_uid, processed_commit_ts FROM shadow) s
    ON f.table_name = 'account' AND s.s_uid = f.user_id
  WHERE f.table_name <> 'unmapped')
"""

ORACLE["q2_shadow_replication"] = with_chg(SHADOWED + f"""
SELECT server_txn_id, record_sequence, shard, {_events_dml('postgresql')} AS dml FROM tested WHERE shard_error IS NULL AND fresh
""")

ORACLE["q2_dead_letters"] = with_chg(SHADOWED + """
SELECT server_txn_id, record_sequence, table_name, coalesce(shard_error, 'older than the last applied commit of its key') AS error
FROM tested WHERE shard_error IS NOT NULL OR NOT fresh
""")

ORACLE["q3_stream_to_buffer"] = with_chg(ASOF_SHARD + f""",
sh AS (SELECT f.*, coalesce(f.shard_id, a.shard) AS shard FROM fwd f
       LEFT JOIN asof_res a ON a.server_txn_id = f.server_txn_id AND a.record_sequence = f.record_sequence
       WHERE coalesce(f.shard_id, a.shard) IS NOT NULL),
parts AS (SELECT shard AS p_shard, row_number() OVER (ORDER BY shard) - 1 AS partition
          FROM (SELECT DISTINCT 'shard' || CAST(c_custkey % 4 AS VARCHAR) AS shard FROM customer))
SELECT shard AS key, CAST(partition AS INTEGER) AS partition,
  row_number() OVER (PARTITION BY shard ORDER BY commit_seconds, commit_nanos, server_txn_id, record_sequence)
    AS position, {MSG_JSON} AS value
FROM sh JOIN parts ON p_shard = shard
""")

ORACLE["q4_buffer_to_database"] = with_chg(f"""
SELECT 'shard' || lpad(CAST(user_id % 100 + 1 AS VARCHAR), 5, '0') AS shard, server_txn_id, record_sequence, {_events_dml('mysql')} AS dml
FROM fwd WHERE table_name <> 'unmapped'
""")

ORACLE["q5_windowed_export"] = with_chg(IMAGE_ASOF + f"""
SELECT shard, {ts_text("time_bucket(INTERVAL 1 hour, commit_ts)")} AS window_start, server_txn_id, record_sequence,
  {MSG_JSON} AS record
FROM imgd WHERE shard_error IS NULL
""")

ORACLE["f1_exact_numbers"] = with_chg("""
SELECT server_txn_id, record_sequence, CASE WHEN mod_type = 'DELETE' THEN 'DELETE FROM accounts WHERE  user_id = ' || user_id
  ELSE 'INSERT INTO accounts(user_id,balance,attrs) VALUES (' || user_id || ',' || event_id || '.01234567890123456789,''{"value":7,"t":"1, 2: 3"}'') '
    || 'ON DUPLICATE KEY UPDATE  balance = ' || event_id || '.01234567890123456789, attrs = ''{"value":7,"t":"1, 2: 3"}''' END AS dml
FROM fwd WHERE table_name = 'account'
""")

ORACLE["w1_release_all"] = with_chg(IMAGE_SHARD + """
SELECT shard, server_txn_id, record_sequence,
  row_number() OVER (PARTITION BY shard ORDER BY commit_seconds, commit_nanos, server_txn_id, record_sequence) AS position,
  (commit_seconds // 21600 + 1) * 21600000 AS released_at_ms
FROM img
""")

ORACLE["w2_release_latest"] = with_chg(IMAGE_SHARD + """,
r AS (SELECT *, (commit_seconds // 21600 + 1) * 21600000 AS released_at_ms,
        row_number() OVER (PARTITION BY shard, commit_seconds // 21600, table_name, keys_json
          ORDER BY commit_seconds DESC, commit_nanos DESC, server_txn_id DESC, record_sequence DESC) AS rn FROM img)
SELECT shard, table_name, keys_json, released_at_ms, server_txn_id, record_sequence FROM r WHERE rn = 1
""")

ORACLE["w10_redistribute"] = with_chg("SELECT server_txn_id, record_sequence, table_name, keys_json FROM fwd")

ORACLE["k7_metadata"] = f"""
SELECT event_type AS run_id, {ts_text("time_bucket(INTERVAL 1 hour, min(ts))")} AS start_ts, '1h' AS window_duration
FROM events WHERE event_type <> 'signup' GROUP BY event_type
UNION ALL SELECT 'signup', '2024-01-01 10:26:00.000000', '10s'
"""

# ----------------------------------------------------------------------------- A7, O4, K10, K11
ORACLE["a7_shard_udf"] = with_chg("""
SELECT server_txn_id, record_sequence, table_name || '-' || CAST(user_id % 3 AS VARCHAR) AS shard, true AS timed
FROM fwd
""")

ORACLE["g6_latency_meter"] = f"""
SELECT 'latency_ms' AS measure, shard, CASE WHEN grouping(shard) = 1 THEN 'all' ELSE 'shard' END AS scope, count(*) AS n, true AS in_order
FROM ({ORACLE['a7_shard_udf']}) GROUP BY ROLLUP (shard)
"""

ORACLE["o4_first_pull"] = with_chg(IMAGE_SHARD + """,
pos AS (SELECT shard, server_txn_id, record_sequence,
          row_number() OVER (PARTITION BY shard ORDER BY commit_seconds, commit_nanos, server_txn_id,
                                                        record_sequence) AS position FROM img)
SELECT * FROM pos WHERE position <= 100
""")

ORACLE["k10_skip_rows"] = with_chg("""
SELECT server_txn_id, record_sequence, table_name, 'skip' AS shard FROM fwd WHERE table_name = 'unmapped'
""")

ORACLE["k11_dead_letters"] = with_chg("""
SELECT 'assign_shard' AS stage, 'shard column not in record' AS error, server_txn_id, record_sequence
FROM fwd WHERE table_name <> 'unmapped' AND shard_id IS NULL
""")
