"""The catalog's queries as ANSI SQL over the same tables, for checking the results."""

from __future__ import annotations

# Adapters (see fixtures.py) as common table expressions.
SNAPS = """
snaps AS (
  SELECT CAST(user_id AS VARCHAR) AS group_id,
         CAST(date_trunc('week', ts) AS TIMESTAMP) AS run_ts, event_type AS member,
         max_by(regexp_extract(props, '([0-9]+)', 1), ts) AS number,
         upper(substr(event_type, 1, 1)) AS position, CAST(COUNT(*) AS BIGINT) AS n_rows
  FROM events GROUP BY 1, 2, 3),
snapshots AS (
  SELECT *, CAST(year(run_ts) - CAST(month(run_ts) < 10 AS INT) AS VARCHAR) AS season FROM snaps)
"""

HIST = """
hist AS (
  SELECT event_id, user_id AS member, ts, event_type AS group_id,
         regexp_extract(props, '([0-9]+)', 1) AS number FROM events)
"""

RAW = """
raw AS (
  SELECT event_id, event_type AS group_id,
         CAST(year(ts) - CAST(month(ts) < 10 AS INT) AS VARCHAR) AS season,
         strftime(ts, '%Y%m%d') AS run_id, ts AS run_ts,
         CAST(user_id AS VARCHAR) AS member_id,
         '/member/' || CAST(user_id AS VARCHAR) AS member_url,
         regexp_extract(props, '([0-9]+)', 1) AS number,
         'User ' || CAST(user_id AS VARCHAR) AS full_name,
         CASE CAST(event_id % 8 AS INT) WHEN 0 THEN 'C' WHEN 1 THEN 'LW' WHEN 2 THEN 'RW'
           WHEN 3 THEN 'F' WHEN 4 THEN 'RW/C' WHEN 5 THEN 'D' WHEN 6 THEN 'G' ELSE 'X' END AS position,
         CAST(event_id % 3 + 70 AS VARCHAR) AS height, CAST(event_id % 2 + 180 AS VARCHAR) AS weight,
         CASE WHEN user_id % 2 = 0 THEN 'L' ELSE 'R' END AS shoots_catches
  FROM events)
"""

GROUP_OF = """CASE WHEN position IN ('C','LW','RW','F','RW/C') THEN 'Forward'
  WHEN position = 'D' THEN 'Defenseman' WHEN position = 'G' THEN 'Goalie' ELSE 'Unknown' END"""

STG = f"""
stg AS (
  SELECT group_id, season, member_id, member_url, number, full_name, position,
         {GROUP_OF} AS position_group, CAST(NULL AS VARCHAR) AS age, height, weight, shoots_catches,
         CAST(NULL AS VARCHAR) AS experience, '' AS birth_date, CAST(NULL AS VARCHAR) AS set_hash, run_ts
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, member_id ORDER BY run_ts DESC) AS rn
        FROM raw WHERE season = '2023') WHERE rn = 1)
"""

DIM_HASH = """md5(group_id || '|' || number || '|' || position || '|' || shoots_catches || '|'
  || height || '|' || weight)"""

DIM = f"""
dim AS (
  SELECT ROW_NUMBER() OVER (ORDER BY member_id, run_ts, group_id) AS member_sk, member_id,
         ROW_NUMBER() OVER (ORDER BY member_id, run_ts, group_id) AS member_nk, full_name,
         split_part(full_name, ' ', 1) AS first_name, split_part(full_name, ' ', -1) AS last_name,
         group_id, number, position, position_group, shoots_catches, height, weight, birth_date,
         run_ts AS effective_date,
         COALESCE(LEAD(run_ts) OVER w, TIMESTAMP '9999-12-31') AS end_date,
         LEAD(run_ts) OVER w IS NULL AS is_current, {DIM_HASH} AS hash_diff
  FROM stg WINDOW w AS (PARTITION BY member_id ORDER BY run_ts))
"""

MESSY = """
messy AS (
  SELECT o_orderkey AS row_id, CAST(year(o_orderdate) AS VARCHAR) AS group_id,
         CAST(year(o_orderdate) - CAST(month(o_orderdate) < 10 AS INT) AS VARCHAR) AS season,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
              ELSE CAST(o_custkey AS VARCHAR) END AS member_id,
         o_orderpriority AS full_name,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS position,
         o_orderdate AS run_ts, lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS run_id
  FROM orders)
"""

FALLBACK = "COALESCE(NULLIF(member_id, ''), 'unknown_' || replace(full_name, ' ', '_'))"

VERSIONS = """
flagged AS (
  SELECT *, LAG(group_id) OVER (PARTITION BY member ORDER BY ts) AS prev FROM hist),
starts AS (SELECT * FROM flagged WHERE prev IS NULL OR prev <> group_id),
versions AS (
  SELECT event_id, member, group_id, ts AS effective_date,
         COALESCE(LEAD(ts) OVER (PARTITION BY member ORDER BY ts), TIMESTAMP '9999-12-31') AS end_date,
         LEAD(ts) OVER (PARTITION BY member ORDER BY ts) IS NULL AS is_current,
         md5(group_id) AS hash_diff
  FROM starts)
"""

DAILY = """
daily AS (
  SELECT user_id AS member, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS run_ts,
         max_by(event_type, ts) AS group_id
  FROM events GROUP BY 1, 2)
"""

DECIDED = """
hashed AS (
  SELECT group_id, season, run_ts, md5(string_agg(member, '||' ORDER BY member)) AS set_hash,
         CAST(COUNT(*) AS BIGINT) AS member_count
  FROM snapshots GROUP BY group_id, season, run_ts),
decided AS (
  SELECT *, previous_hash AS p,
         CASE WHEN previous_hash IS NULL THEN 'new' WHEN previous_hash = set_hash THEN 'unchanged'
              ELSE 'changed' END AS decision
  FROM (SELECT *, LAG(set_hash) OVER (PARTITION BY group_id, season ORDER BY run_ts) AS previous_hash
        FROM hashed))
"""

LOG = """
log AS (
  SELECT strftime(run_ts, '%Y%m%d') AS run_id, group_id, season, decision <> 'unchanged' AS changed,
         set_hash AS current_hash, previous_hash, CAST(member_count AS INT) AS member_count,
         run_ts, decision FROM decided)
"""

STATE = """
state AS (
  SELECT group_id, season, current_hash, run_ts AS last_ingested, run_id AS last_run_id,
         member_count, run_ts AS updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, season ORDER BY run_ts DESC) AS rn
        FROM log) WHERE rn = 1)
"""

PAYLOADS = """
payloads AS (
  SELECT 'e' || CAST(event_id AS VARCHAR) AS row_id, props AS payload FROM events
  UNION ALL SELECT 'p' || CAST(page_id AS VARCHAR), html FROM pages)
"""

# The texts stripped at both ends of every kind of white space.
STRIPPED = r"regexp_replace(regexp_replace(payload, '^[\s\x0b\x1c-\x1f]+', ''), '[\s\x0b\x1c-\x1f]+$', '')"

# Hashes of the documents' members: name, missing number, position.
INGESTED = """
ihashed AS (
  SELECT group_id, season, run_ts,
         md5(string_agg(member || '|N/A|' || position, '||' ORDER BY member)) AS set_hash,
         CAST(COUNT(*) AS INT) AS member_count
  FROM snapshots GROUP BY group_id, season, run_ts),
ilog AS (
  SELECT 'run-1' AS run_id, group_id, season,
         previous_hash IS NULL OR previous_hash <> set_hash AS changed, set_hash AS current_hash,
         previous_hash, member_count, run_ts,
         CASE WHEN previous_hash IS NULL THEN 'new' WHEN previous_hash = set_hash THEN 'unchanged'
              ELSE 'changed' END AS decision
  FROM (SELECT *, LAG(set_hash) OVER (PARTITION BY group_id, season ORDER BY run_ts) AS previous_hash
        FROM ihashed))
"""

BRONZE = f"""
bronze AS (
  SELECT s.group_id, s.season, s.run_ts, strftime(s.run_ts, '%Y%m%d') AS run_id, 'events' AS source,
         member AS member_id, member AS full_name, number, position, CAST(NULL AS VARCHAR) AS age,
         h.set_hash, s.run_ts AS bronze_loaded_at
  FROM snapshots s JOIN hashed h
    ON s.group_id = h.group_id AND s.season = h.season AND s.run_ts = h.run_ts),
manifests AS (
  SELECT group_id, season, run_id, min(set_hash) AS set_hash, CAST(COUNT(*) AS INT) AS member_count,
         max(run_ts) AS run_ts, 'events' AS source
  FROM bronze GROUP BY group_id, season, run_id)
"""

LANDED = """
landed AS (
  SELECT event_type AS group_id, CAST(date_trunc('week', ts) AS TIMESTAMP) AS run_ts,
         CAST(year(date_trunc('week', ts)) - CAST(month(date_trunc('week', ts)) < 10 AS INT) AS VARCHAR) AS season,
         'User ' || CAST(user_id AS VARCHAR) AS full_name,
         regexp_extract(props, '([0-9]+)', 1) AS number
  FROM events)
"""

ORDER_DOCS = """
docs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS group_id, *,
         CAST(year(o_orderdate) - CAST(month(o_orderdate) < 10 AS INT) AS VARCHAR) AS season FROM orders)
"""

def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def _dq(model: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
        f"CAST(({failures}) AS BIGINT) AS failures, ({failures}) = 0 AS passed"
    )


def _not_null(model: str, source: str, column: str) -> str:
    return _dq(model, column, "not_null", f"SELECT COUNT(*) FROM {source} WHERE {column} IS NULL")


def _unique(model: str, source: str, column: str) -> str:
    return _dq(
        model,
        column,
        "unique",
        f"SELECT COUNT(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING COUNT(*) > 1)",
    )


_GROUPS = """
groups AS (SELECT ROW_NUMBER() OVER (ORDER BY group_id) AS group_sk, group_id
           FROM (SELECT DISTINCT group_id FROM raw))
"""

_ASOF = """
  d AS (SELECT member, run_ts + INTERVAL 1 DAY AS ts, group_id FROM daily),
  f AS (SELECT *, LAG(group_id) OVER (PARTITION BY member ORDER BY ts) AS prev FROM d),
  v AS (SELECT member, group_id AS version_group, ts AS effective_date,
               COALESCE(LEAD(ts) OVER (PARTITION BY member ORDER BY ts), TIMESTAMP '9999-12-31') AS end_date
        FROM f WHERE prev IS NULL OR prev <> group_id)
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["scd2_history_collapsed"] = _with(HIST, VERSIONS) + "SELECT * FROM versions"
    q["scd2_history_exact"] = _with(HIST) + """
      SELECT event_id, member, group_id, number, ts AS effective_date,
        COALESCE(LEAD(ts) OVER w, TIMESTAMP '9999-12-31') AS end_date,
        LEAD(ts) OVER w IS NULL AS is_current, md5(group_id || '|' || number) AS hash_diff
      FROM hist WINDOW w AS (PARTITION BY member ORDER BY ts)"""
    q["scd2_closed"] = _with(DAILY, """
      runs AS (SELECT run_ts, LEAD(run_ts) OVER (ORDER BY run_ts) AS next_run
               FROM (SELECT DISTINCT run_ts FROM daily)),
      seen AS (SELECT d.member, d.run_ts, d.group_id, r.next_run,
                 LEAD(d.run_ts) OVER (PARTITION BY d.member ORDER BY d.run_ts) AS next_seen
               FROM daily d JOIN runs r ON d.run_ts = r.run_ts),
      marked AS (SELECT member, run_ts, group_id FROM daily UNION ALL
                 SELECT member, next_run, NULL FROM seen
                 WHERE next_run IS NOT NULL AND (next_seen IS NULL OR next_seen > next_run)),
      flagged AS (SELECT *, LAG(group_id) OVER w AS prev, ROW_NUMBER() OVER w AS rn
                  FROM marked WINDOW w AS (PARTITION BY member ORDER BY run_ts)),
      ranges AS (SELECT *, LEAD(run_ts) OVER (PARTITION BY member ORDER BY run_ts) AS following
                 FROM flagged WHERE rn = 1 OR group_id IS DISTINCT FROM prev)""") + """
      SELECT member, group_id, run_ts AS effective_date,
        COALESCE(following, TIMESTAMP '9999-12-31') AS end_date, following IS NULL AS is_current,
        md5(group_id) AS hash_diff FROM ranges WHERE group_id IS NOT NULL"""
    q["stg_latest"] = _with(RAW, STG) + "SELECT * FROM stg"
    q["stg_latest_messy"] = _with(MESSY) + f"""
      SELECT row_id, group_id, season, member_id, full_name, position, run_ts, {GROUP_OF} AS position_group
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, member_id ORDER BY run_ts DESC, row_id DESC) AS rn
            FROM (SELECT row_id, group_id, season, {FALLBACK} AS member_id, full_name, position, run_ts FROM messy))
      WHERE rn = 1"""
    q["stg_latest_raw_id"] = _with(MESSY) + f"""
      SELECT row_id, group_id, season, {FALLBACK} AS member_id, full_name, position, run_ts, {GROUP_OF} AS position_group
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, member_id ORDER BY run_ts DESC, row_id DESC) AS rn
            FROM messy) WHERE rn = 1"""
    q["scd2_latest_exact"] = _with(RAW, STG, DIM) + "SELECT * FROM dim"
    q["dim_member_history"] = _with(RAW, f"""
      hashed AS (SELECT *, {DIM_HASH} AS hash_diff FROM raw WHERE season = '2023'),
      flagged AS (SELECT *, LAG(hash_diff) OVER (PARTITION BY member_id ORDER BY run_ts) AS prev FROM hashed)""") + f"""
      SELECT ROW_NUMBER() OVER (ORDER BY member_id, run_ts) AS member_sk, member_id, full_name,
        split_part(full_name, ' ', 1) AS first_name, split_part(full_name, ' ', -1) AS last_name,
        group_id, number, position, {GROUP_OF} AS position_group, shoots_catches, height, weight,
        '' AS birth_date, run_ts AS effective_date,
        COALESCE(LEAD(run_ts) OVER w, TIMESTAMP '9999-12-31') AS end_date,
        LEAD(run_ts) OVER w IS NULL AS is_current, hash_diff
      FROM flagged WHERE prev IS NULL OR prev <> hash_diff
      WINDOW w AS (PARTITION BY member_id ORDER BY run_ts)"""
    q["dim_group"] = """
      SELECT ROW_NUMBER() OVER (ORDER BY group_id) AS group_sk, group_id,
        COALESCE(n_name, group_id) AS group_name, CAST(1 AS INT) AS active_flag
      FROM (SELECT DISTINCT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS group_id, c_nationkey FROM customer)
      LEFT JOIN nation ON n_nationkey = c_nationkey"""
    q["surrogate_key_orders"] = """
      SELECT o_orderkey, o_orderdate, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk
      FROM orders"""

    q["set_hash_snapshots"] = _with(SNAPS) + """
      SELECT group_id, season, run_ts,
        md5(string_agg(member || '|' || number || '|' || position, '||' ORDER BY member, number, position)) AS set_hash,
        CAST(COUNT(*) AS BIGINT) AS member_count
      FROM snapshots GROUP BY group_id, season, run_ts"""
    q["set_digest_snapshots"] = _with(SNAPS) + """
      SELECT group_id, season, run_ts, member_count,
        MIN(run_ts) OVER (PARTITION BY group_id, season, members) AS first_run
      FROM (SELECT group_id, season, run_ts, CAST(COUNT(*) AS BIGINT) AS member_count,
              string_agg(member || '|' || position, '||' ORDER BY member, position) AS members
            FROM snapshots GROUP BY group_id, season, run_ts)"""
    q["set_hash_orders"] = _with(MESSY) + """
      SELECT group_id, season,
        md5(string_agg(full_name || '|' || run_id || '|' || COALESCE(position, ''), '||'
            ORDER BY full_name, run_id, COALESCE(position, ''))) AS set_hash,
        CAST(COUNT(*) AS BIGINT) AS member_count
      FROM messy GROUP BY group_id, season"""
    q["rows_with_set_hash"] = _with(SNAPS, DECIDED) + """
      SELECT s.*, h.set_hash FROM snapshots s JOIN hashed h
        ON s.group_id = h.group_id AND s.season = h.season AND s.run_ts = h.run_ts"""
    q["named_members"] = _with(MESSY) + """
      SELECT group_id, CAST(COUNT(*) AS BIGINT) AS named FROM messy
      WHERE trim(COALESCE(member_id, '')) <> '' GROUP BY group_id"""
    q["change_decision"] = _with(SNAPS, DECIDED) + """
      SELECT group_id, season, run_ts, set_hash, member_count, previous_hash, decision FROM decided"""
    q["change_decision_digest"] = _with(SNAPS, DECIDED) + """
      SELECT group_id, season, run_ts, member_count, decision FROM decided"""
    q["change_decision_incremental"] = _with(SNAPS, DECIDED) + """
      SELECT group_id, season, run_ts, set_hash, member_count, previous_hash, decision FROM decided
      WHERE run_ts >= TIMESTAMP '2024-01-15'"""
    q["change_decision_forced"] = _with(SNAPS, DECIDED, """
      old AS (SELECT group_id, season, max(run_ts) AS last_ts, max_by(set_hash, run_ts) AS last_hash
              FROM hashed WHERE run_ts < TIMESTAMP '2024-01-15' GROUP BY group_id, season)""") + """
      SELECT d.group_id, d.season, d.run_ts, d.set_hash, d.member_count,
        CASE WHEN d.run_ts <= o.last_ts THEN o.last_hash ELSE d.previous_hash END AS previous_hash,
        CASE WHEN d.run_ts <= o.last_ts THEN 'late' ELSE 'new' END AS decision
      FROM decided d LEFT JOIN old o ON d.group_id = o.group_id AND d.season = o.season"""
    q["change_decision_bronze"] = q["change_decision_incremental"]
    q["change_log"] = _with(SNAPS, DECIDED, LOG) + "SELECT * FROM log"
    q["state_upsert"] = _with(SNAPS, DECIDED, LOG, STATE) + "SELECT * FROM state"
    q["state_lookup"] = _with(SNAPS, DECIDED, LOG, STATE) + """
      SELECT * FROM state WHERE (group_id, season) IN (
        SELECT CAST(user_id AS VARCHAR),
               CAST(year(w) - CAST(month(w) < 10 AS INT) AS VARCHAR)
        FROM (SELECT user_id, date_trunc('week', ts) AS w FROM events WHERE event_type = 'error'))"""
    q["state_listing"] = (
        _with(SNAPS, DECIDED, LOG, STATE) + "SELECT * FROM state ORDER BY group_id, season"
    )
    q["empty_snapshots"] = _with(SNAPS) + """
      SELECT CAST(c_custkey AS VARCHAR) AS group_id, '2023' AS season, 'failed' AS status,
        CAST(0 AS BIGINT) AS member_count, 'no members found' AS error
      FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM snapshots s WHERE s.group_id = CAST(c.c_custkey AS VARCHAR) AND s.season = '2023')"""
    q["skip_ratio"] = _with(SNAPS, DECIDED) + """
      SELECT group_id, CAST(COUNT(*) AS BIGINT) AS snapshots,
        CAST(COUNT(*) FILTER (decision <> 'unchanged') AS BIGINT) AS written,
        CAST(COUNT(*) FILTER (decision = 'unchanged') AS BIGINT) AS skipped,
        CAST(COUNT(*) FILTER (decision = 'unchanged') AS DOUBLE) / COUNT(*) AS skip_ratio
      FROM decided GROUP BY group_id"""
    q["member_count"] = _with(SNAPS) + """
      SELECT group_id, season, run_ts, CAST(COUNT(*) AS BIGINT) AS member_count
      FROM snapshots GROUP BY group_id, season, run_ts"""

    # From the rows themselves, not from the versions: the latest row at that time.
    q["point_in_time"] = _with(HIST, VERSIONS) + """
      SELECT r.member, r.group_id, v.effective_date, v.end_date
      FROM (SELECT member, max_by(group_id, ts) AS group_id, max(ts) AS ts FROM hist
            WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY member) r
      JOIN versions v ON v.member = r.member AND v.effective_date <= r.ts AND r.ts < v.end_date"""
    q["point_in_time_dates"] = _with(HIST, VERSIONS) + """
      SELECT as_of, member, group_id, effective_date
      FROM versions JOIN (VALUES (TIMESTAMP '2024-01-05'), (TIMESTAMP '2024-01-12'),
        (TIMESTAMP '2024-01-19'), (TIMESTAMP '2024-01-26')) AS dates(as_of)
      ON effective_date <= as_of AND as_of < end_date"""
    q["asof_version_join"] = _with(HIST, DAILY, _ASOF) + """
      SELECT h.event_id, h.member, h.ts, v.version_group, v.effective_date, v.end_date
      FROM hist h JOIN v ON h.member = v.member AND v.effective_date <= h.ts AND h.ts < v.end_date"""
    q["asof_version_join_left"] = _with(HIST, DAILY, _ASOF) + """
      SELECT h.event_id, h.member, h.ts, v.version_group, v.effective_date, v.end_date
      FROM hist h LEFT JOIN v ON h.member = v.member AND v.effective_date <= h.ts AND h.ts < v.end_date"""
    q["attribute_changes"] = _with(HIST, """
      moved AS (SELECT member, ts, group_id, number, LAG(group_id) OVER w AS old_group,
                  LAG(number) OVER w AS old_number, LAG(ts) OVER w AS before
                FROM hist WINDOW w AS (PARTITION BY member ORDER BY ts))""") + """
      SELECT member, ts AS changed_at, 'group_id' AS attribute, old_group AS old_value, group_id AS new_value
      FROM moved WHERE before IS NOT NULL AND old_group IS DISTINCT FROM group_id
      UNION ALL
      SELECT member, ts, 'number', old_number, number
      FROM moved WHERE before IS NOT NULL AND old_number IS DISTINCT FROM number"""
    q["members_used"] = _with(SNAPS) + """
      SELECT group_id, season, CAST(COUNT(DISTINCT member) AS BIGINT) AS members_used
      FROM snapshots GROUP BY group_id, season"""
    q["members_used_history"] = _with(RAW) + """
      SELECT group_id, season, CAST(COUNT(DISTINCT member_id) AS BIGINT) AS members_used
      FROM raw GROUP BY group_id, season"""
    q["membership_diff"] = _with(SNAPS, """
      runs AS (SELECT group_id, run_ts, LAG(run_ts) OVER w AS before
               FROM (SELECT DISTINCT group_id, run_ts FROM snapshots)
               WINDOW w AS (PARTITION BY group_id ORDER BY run_ts)),
      now_listed AS (SELECT r.group_id, r.run_ts, r.before, s.member FROM runs r JOIN snapshots s
                     ON s.group_id = r.group_id AND s.run_ts = r.run_ts),
      was_listed AS (SELECT r.group_id, r.run_ts, s.member FROM runs r JOIN snapshots s
                     ON s.group_id = r.group_id AND s.run_ts = r.before)""") + """
      SELECT COALESCE(n.group_id, w.group_id) AS group_id, COALESCE(n.run_ts, w.run_ts) AS run_ts,
        COALESCE(n.member, w.member) AS member,
        CASE WHEN n.member IS NULL THEN 'left' WHEN w.member IS NULL THEN 'joined' ELSE 'stayed' END AS status
      FROM now_listed n FULL OUTER JOIN was_listed w
        ON n.group_id = w.group_id AND n.run_ts = w.run_ts AND n.member = w.member"""

    q["dq_report"] = _with(RAW, STG, DIM, _GROUPS) + "\nUNION ALL ".join(
        [_not_null("stg_members", "stg", c) for c in ("member_id", "full_name", "group_id", "season")]
        + [_not_null("dim_group", "groups", c) for c in ("group_sk", "group_id")]
        + [_unique("dim_group", "groups", c) for c in ("group_sk", "group_id")]
        + [_not_null("dim_member", "dim", c) for c in ("member_sk", "member_id", "is_current")]
        + [_unique("dim_member", "dim", "member_sk")]
    )
    q["dq_messy"] = _with(MESSY) + "\nUNION ALL ".join(
        [_not_null("messy", "messy", c) for c in ("row_id", "member_id", "position", "full_name")]
        + [_unique("messy", "messy", c) for c in ("row_id", "member_id", "position")]
    )
    q["warehouse_counts"] = _with(RAW, STG, DIM, _GROUPS) + """
      SELECT 'raw_groups' AS metric, CAST(COUNT(DISTINCT group_id) AS BIGINT) AS value FROM raw
      UNION ALL SELECT 'raw_members', COUNT(DISTINCT member_id) FROM raw
      UNION ALL SELECT 'raw_records', COUNT(*) FROM raw
      UNION ALL SELECT 'dim_groups', COUNT(*) FROM groups
      UNION ALL SELECT 'dim_members', COUNT(DISTINCT member_id) FROM dim
      UNION ALL SELECT 'current_members', CAST(SUM(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) FROM dim"""

    q["flatten_sections"] = _with(ORDER_DOCS) + """
      SELECT group_id, season, 'Forward' AS section, CAST(o_custkey AS VARCHAR) AS member_id,
        '/member/' || CAST(o_custkey AS VARCHAR) AS member_url, CAST(o_orderkey % 100 AS VARCHAR) AS number,
        'Cust ' || CAST(o_custkey AS VARCHAR) AS full_name, 'LW' AS position, 'N/A' AS height,
        'N/A' AS weight, 'N/A' AS shoots_catches, strftime(o_orderdate, '%Y-%m-%d') AS birth_date,
        '' AS birth_country, TRUE AS rookie, FALSE AS captain
      FROM docs
      UNION ALL
      SELECT group_id, season, 'Forward', '', '/member/', 'N/A', 'Spare ' || CAST(o_orderkey AS VARCHAR),
        'C', 'N/A', 'N/A', 'N/A', '', '', FALSE, FALSE FROM docs WHERE o_orderstatus = 'F'
      UNION ALL
      SELECT group_id, season, 'Defenseman', CAST(o_orderkey AS VARCHAR),
        '/member/' || CAST(o_orderkey AS VARCHAR), 'N/A', o_orderpriority, 'D', '70', 'N/A', 'N/A',
        strftime(o_orderdate, '%Y'), '', FALSE, FALSE FROM docs WHERE o_orderstatus <> 'O'"""
    q["landed_documents"] = _with(LANDED) + """
      SELECT group_id, season, run_ts, 'Goalie' AS section, full_name FROM landed"""
    kind = f"CASE WHEN {STRIPPED}[1] IN ('{{', '[') THEN 'json' ELSE 'html' END"
    q["payload_kind"] = _with(PAYLOADS) + f"""
      SELECT row_id, {kind} AS kind, md5({STRIPPED}) AS payload_md5 FROM payloads"""
    q["payload_sink"] = _with(PAYLOADS) + f"""
      SELECT row_id AS group_id, {kind} AS payload_kind, md5({STRIPPED}) AS payload_md5 FROM payloads"""
    q["season_of_date"] = """
      SELECT o_orderkey AS id, y AS season_year, CAST(y AS VARCHAR) AS season,
        CAST(y AS VARCHAR) || CAST(y + 1 AS VARCHAR) AS season_long, CAST(y AS VARCHAR) AS season_short,
        CAST(CASE WHEN month(o_orderdate) < 7 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS VARCHAR)
          AS season_from_july
      FROM (SELECT *, CASE WHEN month(o_orderdate) < 10 THEN year(o_orderdate) - 1
                           ELSE year(o_orderdate) END AS y FROM orders)"""
    q["fallback_id"] = _with(MESSY) + f"SELECT row_id, {FALLBACK} AS member_id FROM messy"
    q["split_name"] = """
      SELECT id, split_part(full_name, ' ', 1) AS first_name, split_part(full_name, ' ', -1) AS last_name
      FROM (SELECT p_partkey AS id, p_name AS full_name FROM part
            UNION ALL SELECT c_custkey + 1000000000000, c_name FROM customer)"""
    q["row_hash_orders"] = _with(MESSY) + """
      SELECT row_id, md5(COALESCE(member_id, '') || '|' || COALESCE(full_name, '') || '|' || COALESCE(position, ''))
        AS hash_diff FROM messy"""
    q["position_group"] = _with(RAW) + f"""
      SELECT position, {GROUP_OF} AS position_group, CAST(COUNT(*) AS BIGINT) AS members FROM raw
      GROUP BY 1, 2
      UNION ALL
      SELECT position, {GROUP_OF}, CAST(COUNT(*) AS BIGINT)
      FROM (SELECT CASE upper(substr(event_type, 1, 1)) WHEN 'C' THEN 'CLICK' WHEN 'P' THEN 'P1'
              ELSE upper(substr(event_type, 1, 1)) END AS position FROM events) GROUP BY 1, 2"""
    q["code_lookup"] = """
      SELECT c_custkey, COALESCE(n_name, CAST(c_nationkey AS VARCHAR)) AS nation_name,
        CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Household goods' WHEN 'MACHINERY' THEN 'Machines'
          ELSE c_mktsegment END AS segment_name
      FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""
    for name, sign in (("tracked_groups", "="), ("untracked_groups", "<>")):
        q[name] = f"""
          SELECT n_name AS group_id, CAST(COUNT(*) AS BIGINT) AS members
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = n_regionkey
          WHERE r_name {sign} 'ASIA' GROUP BY n_name"""

    bronze = _with(SNAPS, DECIDED, BRONZE)
    q["bronze_roundtrip"] = bronze + "SELECT * FROM bronze"
    q["bronze_latest_hash"] = bronze + """
      SELECT group_id, season, max_by(set_hash, run_ts) AS set_hash, max(run_ts) AS run_ts
      FROM bronze GROUP BY group_id, season"""
    q["bronze_missing_groups"] = bronze + """
      SELECT CAST(c_custkey AS VARCHAR) AS group_id, '2023' AS season FROM customer c
      WHERE NOT EXISTS (SELECT 1 FROM bronze b
                        WHERE b.group_id = CAST(c.c_custkey AS VARCHAR) AND b.season = '2023')"""
    q["run_manifest"] = bronze + "SELECT * FROM manifests"
    q["latest_run"] = bronze + """
      SELECT group_id, season, run_id, set_hash, member_count, run_ts, source
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, season ORDER BY run_ts DESC) AS rn
            FROM manifests) WHERE rn = 1"""
    q["list_runs"] = bronze + """
      SELECT group_id, run_id, member_count FROM manifests WHERE season = '2023'
      ORDER BY group_id, run_id"""
    q["schema_aligned_load"] = _with(MESSY) + """
      SELECT group_id, season, 'r1' AS run_id, run_ts, CAST(NULL AS VARCHAR) AS source, member_id,
        CAST(NULL AS VARCHAR) AS member_url, CAST(NULL AS VARCHAR) AS number, full_name, position,
        CAST(NULL AS VARCHAR) AS age, CAST(NULL AS VARCHAR) AS height, CAST(NULL AS VARCHAR) AS weight,
        CAST(NULL AS VARCHAR) AS shoots_catches, CAST(NULL AS VARCHAR) AS experience,
        CAST(NULL AS VARCHAR) AS birth_date, CAST(NULL AS VARCHAR) AS summary,
        CAST(NULL AS VARCHAR) AS set_hash, CAST(NULL AS TIMESTAMP) AS bronze_loaded_at,
        TIMESTAMP '2024-01-15' AS load_ts
      FROM messy"""

    ingested = _with(SNAPS, INGESTED)
    q["ingest_log"] = ingested + "SELECT * FROM ilog"
    q["stream_ingest_log"] = _with(LANDED, """
      h AS (SELECT group_id, season, run_ts, CAST(COUNT(*) AS INT) AS member_count,
              md5(string_agg(full_name || '|' || number || '|N/A', '||' ORDER BY full_name, number)) AS current_hash
            FROM landed GROUP BY group_id, season, run_ts),
      l AS (SELECT *, LAG(current_hash) OVER (PARTITION BY group_id, season ORDER BY run_ts) AS previous_hash
            FROM h)""") + """
      SELECT group_id, season, previous_hash IS NULL OR previous_hash <> current_hash AS changed,
        current_hash, previous_hash, member_count, run_ts,
        CASE WHEN previous_hash IS NULL THEN 'new' WHEN previous_hash = current_hash THEN 'unchanged'
             ELSE 'changed' END AS decision
      FROM l"""
    q["ingest_state"] = ingested + """
      SELECT group_id, season, current_hash, run_ts AS last_ingested, 'run-1' AS last_run_id, member_count,
        TIMESTAMP '2024-02-05' AS updated_at
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY group_id, season ORDER BY run_ts DESC) AS rn FROM ilog)
      WHERE rn = 1"""
    q["ingest_raw_members"] = ingested + """
      SELECT s.group_id, s.season, s.run_ts, member AS member_id, 'N/A' AS number, member AS full_name,
        position, l.current_hash AS set_hash
      FROM snapshots s JOIN ilog l ON s.group_id = l.group_id AND s.season = l.season AND s.run_ts = l.run_ts
      WHERE l.changed"""
    q["run_summary"] = ingested + """
      SELECT 'run-1' AS run_id, TIMESTAMP '2024-02-05' AS run_ts, CAST(1 AS BIGINT) AS state_version,
        CAST(COUNT(*) AS BIGINT) AS total_groups, CAST(SUM(n) AS BIGINT) AS total_members,
        CAST(COUNT(*) AS BIGINT) AS groups_with_bronze, CAST(0 AS BIGINT) AS groups_failed,
        CAST(0 AS BIGINT) AS groups_in_error
      FROM (SELECT group_id, season, COUNT(*) AS n FROM snapshots GROUP BY group_id, season)"""
    q["warehouse_sql"] = ingested + """
      , st AS (SELECT group_id, season, max_by(member_count, run_ts) AS member_count FROM ilog
               GROUP BY group_id, season)
      SELECT s.group_id, st.member_count, CAST(COUNT(*) AS BIGINT) AS stored_rows
      FROM snapshots s JOIN ilog l ON s.group_id = l.group_id AND s.season = l.season AND s.run_ts = l.run_ts
        JOIN st ON st.group_id = s.group_id AND st.season = s.season
      WHERE l.changed GROUP BY s.group_id, st.season, st.member_count"""
    q["ingest_incremental"] = q["ingest_raw_members"]
    q["ingest_replay"] = ingested + """
      SELECT CASE WHEN run_ts < TIMESTAMP '2024-01-08' THEN 'b1' WHEN run_ts < TIMESTAMP '2024-01-22' THEN 'b2'
                  ELSE 'b3' END AS run_id, decision, CAST(COUNT(*) AS BIGINT) AS snapshots,
        CAST(CASE WHEN run_ts < TIMESTAMP '2024-01-08' THEN 1 WHEN run_ts < TIMESTAMP '2024-01-22' THEN 2
                  ELSE 3 END AS BIGINT) AS state_version
      FROM ilog GROUP BY ALL"""
    # Moves: a member joins at a stored run of its group if the run before does not list it, and leaves
    # at one that does not list it if the run before does.
    q["scd2_closed_groups"] = ingested + """
      , runs AS (SELECT group_id, season, run_ts, LAG(run_ts) OVER w AS run_before, LEAD(run_ts) OVER w AS run_after
                 FROM ilog WHERE changed WINDOW w AS (PARTITION BY group_id, season ORDER BY run_ts)),
      present AS (SELECT r.*, s.member FROM runs r JOIN snapshots s
                  ON s.group_id = r.group_id AND s.season = r.season AND s.run_ts = r.run_ts),
      joins AS (SELECT p.group_id, p.season, p.member, p.run_ts FROM present p
                WHERE NOT EXISTS (SELECT 1 FROM present q WHERE q.group_id = p.group_id AND q.season = p.season
                                  AND q.member = p.member AND q.run_ts = p.run_before)),
      leaves AS (SELECT p.group_id, p.season, p.member, p.run_after AS run_ts FROM present p
                 WHERE p.run_after IS NOT NULL
                   AND NOT EXISTS (SELECT 1 FROM present q WHERE q.group_id = p.group_id AND q.season = p.season
                                   AND q.member = p.member AND q.run_ts = p.run_after))
      SELECT j.group_id || '/' || j.season || '/' || j.member AS member, j.run_ts AS effective_date,
        COALESCE(MIN(l.run_ts), TIMESTAMP '9999-12-31') AS end_date, MIN(l.run_ts) IS NULL AS is_current
      FROM joins j LEFT JOIN leaves l ON l.group_id = j.group_id AND l.season = j.season
        AND l.member = j.member AND l.run_ts > j.run_ts
      GROUP BY ALL"""
    q["ingest_errors"] = _with(SNAPS) + """
      , g AS (SELECT group_id, season, CAST(group_id AS BIGINT) % 5 AS kind, COUNT(*) AS n FROM snapshots GROUP BY ALL)
      SELECT group_id, season,
        CASE WHEN kind IN (1, 2) THEN 'error' WHEN kind = 3 THEN 'failed' ELSE 'success' END AS status,
        CAST(CASE WHEN kind IN (2, 3) THEN 0 ELSE n END AS BIGINT) AS member_count, kind IN (0, 4) AS wrote_bronze,
        CASE WHEN kind IN (1, 2) THEN 'document cannot be parsed' WHEN kind = 3 THEN 'no members found' END AS error
      FROM g"""
    q["stream_ingest_split"] = _with(LANDED, """
      h AS (SELECT group_id, season, run_ts,
              md5(string_agg(full_name || '|' || number || '|N/A', '||' ORDER BY full_name, number)) AS set_hash
            FROM landed GROUP BY group_id, season, run_ts),
      l AS (SELECT *, LAG(set_hash) OVER (PARTITION BY group_id, season ORDER BY run_ts) AS previous FROM h)""") + """
      SELECT d.group_id, d.season, d.run_ts, replace(full_name, 'User ', '') AS member_id, number, full_name, set_hash
      FROM landed d JOIN l ON d.group_id = l.group_id AND d.season = l.season AND d.run_ts = l.run_ts
      WHERE previous IS DISTINCT FROM set_hash"""
    season = "CAST(year(run_ts) - CAST(month(run_ts) < 10 AS INT) AS VARCHAR)"
    q["stream_ingest_parts"] = _with(f"""
      ev AS (SELECT DISTINCT event_type AS group_id, CAST(date_trunc('week', ts) AS TIMESTAMP) AS run_ts, user_id FROM events),
      listed AS (SELECT w.group_id, w.run_ts, b.user_id FROM (SELECT DISTINCT group_id, run_ts FROM ev) w
                 JOIN (SELECT DISTINCT group_id, user_id FROM ev WHERE user_id % 3 <> 0) b ON w.group_id = b.group_id
                 UNION ALL SELECT group_id, run_ts, user_id FROM ev WHERE user_id % 3 = 0),
      named AS (SELECT group_id, {season} AS season, run_ts, CAST(user_id AS VARCHAR) AS member_id,
                  'User ' || CAST(user_id AS VARCHAR) AS full_name FROM listed),
      h AS (SELECT group_id, season, run_ts,
              md5(string_agg(full_name || '|N/A|N/A', '||' ORDER BY full_name)) AS set_hash
            FROM named GROUP BY group_id, season, run_ts),
      l AS (SELECT *, LAG(set_hash) OVER (PARTITION BY group_id, season ORDER BY run_ts) AS previous FROM h)""") + """
      SELECT d.group_id, d.season, d.run_ts, member_id, full_name, set_hash
      FROM named d JOIN l ON d.group_id = l.group_id AND d.season = l.season AND d.run_ts = l.run_ts
      WHERE previous IS DISTINCT FROM set_hash"""
    q["scd2_merge"] = q["scd2_history_collapsed"]
    q["member_keys"] = """
      SELECT member_id, ROW_NUMBER() OVER (ORDER BY batch, member_id) AS member_nk,
        CASE WHEN batch = 0 THEN ROW_NUMBER() OVER (ORDER BY batch, member_id) END AS first_nk
      FROM (SELECT CAST(user_id AS VARCHAR) AS member_id, MIN(day(ts) // 11) AS batch FROM events GROUP BY 1)"""
    q["stamped_groups"] = """
      SELECT DISTINCT event_type AS group_id, TIMESTAMP '2024-01-15' AS created_at, TIMESTAMP '2024-01-15' AS updated_at
      FROM events"""
    q["set_hash_tree"] = _with(SNAPS, """
      m AS (SELECT group_id, season, run_ts, member || '|' || number || '|' || position AS t FROM snapshots),
      leaves AS (SELECT group_id, season, run_ts, substr(md5(t), 1, 2) AS path,
                   md5(string_agg(t, '||' ORDER BY t)) AS h, COUNT(*) AS n FROM m GROUP BY 1, 2, 3, 4),
      mid AS (SELECT group_id, season, run_ts, substr(path, 1, 1) AS path,
                md5(string_agg(path || ':' || h, '||' ORDER BY path || ':' || h)) AS h, SUM(n) AS n
              FROM leaves GROUP BY 1, 2, 3, 4)""") + """
      SELECT group_id, season, run_ts, md5(string_agg(path || ':' || h, '||' ORDER BY path || ':' || h)) AS set_hash,
        CAST(SUM(n) AS BIGINT) AS member_count
      FROM mid GROUP BY 1, 2, 3"""
    q["membership_diff_trees"] = f"SELECT * FROM ({q['membership_diff']}) WHERE status <> 'stayed'"
    q["stg_latest_bucketed"] = q["stg_latest"]
    q["stored_tree_changes"] = _with(SNAPS, """
      old AS (SELECT group_id, season, member, number FROM snapshots WHERE run_ts = TIMESTAMP '2024-01-08'),
      new AS (SELECT group_id, season, member, number FROM snapshots WHERE run_ts = TIMESTAMP '2024-01-15')""") + """
      SELECT *, 'left' AS status FROM (SELECT * FROM old EXCEPT SELECT * FROM new)
      UNION ALL SELECT *, 'joined' FROM (SELECT * FROM new EXCEPT SELECT * FROM old)"""
    q["dq_unique_incremental"] = _with(MESSY, """
      vals AS (SELECT CAST(row_id % 3 AS INT) AS run, concat_ws('/', full_name, CAST(row_id % 4001 AS VARCHAR)) AS value FROM messy)""") + """
      SELECT run, (SELECT COUNT(*) FROM (SELECT value FROM vals v WHERE v.run <= r.run GROUP BY value HAVING COUNT(*) > 1)) AS repeated
      FROM (SELECT DISTINCT run FROM vals) r"""
    q["landing_replay"] = q["ingest_raw_members"]
    q["point_in_time_images"] = q["point_in_time"]
    q["dq_failing_rows"] = _with(MESSY) + """
      SELECT 'messy' AS model, 'member_id' AS column_name, 'not_null' AS test, row_id FROM messy WHERE member_id IS NULL
      UNION ALL SELECT 'messy', 'position', 'not_null', row_id FROM messy WHERE position IS NULL
      UNION ALL SELECT 'messy', 'member_id', 'unique', row_id FROM messy
      WHERE member_id IN (SELECT member_id FROM messy WHERE member_id IS NOT NULL GROUP BY member_id HAVING COUNT(*) > 1)"""
    q["members_used_sketch"] = _with(RAW) + """
      SELECT group_id, season, COUNT(DISTINCT member_id) AS members_used, COUNT(*) AS member_rows, TRUE AS is_close
      FROM raw GROUP BY group_id, season"""
    q["mart_rebuild"] = _with(SNAPS) + """
      SELECT group_id, season, COUNT(DISTINCT member) AS members_used FROM snapshots GROUP BY ALL"""
    q["stg_season_orders"] = _with(MESSY) + f"""
      SELECT row_id, group_id, season, {FALLBACK} AS member_id, {GROUP_OF} AS position_group
      FROM messy WHERE season = '1997'"""
    return q
