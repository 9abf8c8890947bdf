"""SQL that computes every registered query a second time, written from the semantics alone.

The statements follow the plain definition (``EXISTS`` and ``NOT EXISTS``, grouping after the
joins) and not the plans of the operators.
"""

from __future__ import annotations

CTES = {
    "change_feed": """
        SELECT CASE WHEN o_orderkey % 89 = 0 THEN NULL
                    ELSE concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Cust' ELSE 'cust' END,
                                CAST(o_custkey AS VARCHAR)) END AS entity_id,
               concat('raw_', lower(l_linestatus)) AS schema_name,
               nullif(concat('t_', l_returnflag, CAST(l_linenumber AS VARCHAR)), 't_N1') AS object_name,
               l_shipdate AS updated
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "readiness": """
        SELECT concat(v.prefix, CAST(c_custkey AS VARCHAR)) AS entity_id,
               s.schema_name,
               CASE WHEN c_acctbal BETWEEN 0 AND 500 THEN NULL ELSE c_acctbal > 0 END AS ready_for_processing,
               c_mktsegment <> 'FURNITURE' AS data_available,
               CASE WHEN c_nationkey % 5 = 0 THEN 'OTHER' ELSE 'MAIN' END AS source,
               CASE WHEN (c_custkey + v.shift // 30) % 3 = 0 THEN NULL
                    ELSE (c_custkey + v.shift // 30) % 3 = 1 END AS migrated,
               CAST(DATE '1995-01-01' + CAST((c_custkey * 37 + v.shift) % 2500 AS INTEGER) AS TIMESTAMP)
                   + CASE WHEN c_custkey % 4 = 0 THEN INTERVAL '12:34:56.789' ELSE INTERVAL '0 days' END AS updated
        FROM customer,
             (VALUES ('raw_f'), ('raw_o')) s(schema_name),
             (VALUES ('Cust', 0), ('cust', 30), ('cust', 60)) v(prefix, shift)
        WHERE v.shift <> 60 OR c_custkey % 5 = 0""",
    "run_registry": """
        SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL
                    ELSE concat('CUST', CAST(c_custkey AS VARCHAR)) END AS entity_id, batch_id,
               CASE WHEN batch_id = 'B1' AND c_custkey % 11 = 0 THEN 'N'
                    WHEN batch_id <> 'B1' AND c_custkey % 2 = 0 THEN 'N' ELSE 'Y' END AS active_flag
        FROM customer, (VALUES ('B1'), ('B2'), ('B3')) b(batch_id)
        WHERE (batch_id IN ('B1', 'B2') AND c_custkey % 7 <> 0 AND (batch_id = 'B1' OR c_custkey % 5 = 0))
           OR (batch_id = 'B3' AND c_custkey % 3 = 0)""",
    "run_log": """
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE concat('CUST', CAST(o_custkey AS VARCHAR)) END AS entity_id,
               CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'COMPLETED' ELSE 'STARTED' END AS batch_status,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'COMPLETED' ELSE 'RUNNING' END AS job_status,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'OTHER' ELSE 'MAIN' END AS subject_area,
               o_orderdate AS batch_start_ts,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS src_refresh_ts
        FROM orders""",
    "control": """
        SELECT DISTINCT schema_name, object_name AS table_name,
               CASE WHEN object_name = 't_N3' THEN 'cust1' END AS entity_id,
               TIMESTAMP '1999-01-01 00:00:00' AS created_timestamp,
               TIMESTAMP '1999-01-01 00:00:00' AS updated_timestamp,
               CASE WHEN object_name = 't_A1' THEN NULL
                    WHEN object_name = 't_N2' THEN TIMESTAMP '1997-03-04 05:06:07.25'
                    WHEN object_name = 'change_feed' THEN TIMESTAMP '1998-01-01 00:00:00'
                    WHEN object_name = '' THEN TIMESTAMP '1999-01-01 00:00:00'
                    ELSE TIMESTAMP '1999-01-01 00:00:00' - to_days(ascii(right(object_name, 1)) % 7)
               END AS last_modified_datetime
        FROM (SELECT schema_name, coalesce(object_name, '') AS object_name FROM change_feed
              UNION ALL SELECT 'raw_o', 't_quiet'
              UNION ALL SELECT 'meta', 'change_feed')
        WHERE object_name NOT LIKE 't!_R%' ESCAPE '!'""",
    "dispatch_attempts": """
        SELECT concat('CUST', CAST(user_id AS VARCHAR)) AS entity_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt_no,
               CASE WHEN event_type IN ('click', 'purchase') THEN 200
                    WHEN event_type = 'view' THEN 503
                    WHEN event_type = 'signup' THEN 429
                    WHEN event_id % 4 = 0 THEN NULL ELSE 400 END AS status_code
        FROM events""",
    "watermarks": """
        SELECT s.schema_name, s.object_name,
               coalesce(c.last_modified_datetime, TIMESTAMP '1990-01-01 00:00:00') AS watermark
        FROM (SELECT DISTINCT schema_name, coalesce(object_name, '') AS object_name FROM change_feed) s
        LEFT JOIN control c ON c.schema_name = s.schema_name AND c.table_name = s.object_name""",
    "changed": """
        SELECT * FROM change_feed WHERE updated > TIMESTAMP '1999-01-01 00:00:00'""",
    "changed_by_source": """
        SELECT f.* FROM change_feed f
        LEFT JOIN watermarks w ON w.schema_name = f.schema_name AND w.object_name = coalesce(f.object_name, '')
        WHERE f.updated > coalesce(w.watermark, TIMESTAMP '1990-01-01 00:00:00')""",
    "matched": """
        SELECT c.entity_id, c.schema_name, coalesce(c.object_name, '') AS object_name, r.migrated, r.updated
        FROM changed c JOIN readiness r ON c.entity_id = r.entity_id AND c.schema_name = r.schema_name
        WHERE r.ready_for_processing IS TRUE AND r.data_available IS TRUE AND r.source = 'MAIN'""",
    "matched_by_source": """
        SELECT c.entity_id, c.schema_name, coalesce(c.object_name, '') AS object_name, r.migrated, r.updated
        FROM changed_by_source c JOIN readiness r ON c.entity_id = r.entity_id AND c.schema_name = r.schema_name
        WHERE r.ready_for_processing IS TRUE AND r.data_available IS TRUE AND r.source = 'MAIN'""",
    "candidates": """
        SELECT lower(entity_id) AS entity_id, schema_name,
               list_sort(list(DISTINCT object_name)) AS objects,
               CAST(bool_or(coalesce(migrated, FALSE)) AS VARCHAR) AS migrated,
               max(updated) AS updated
        FROM matched GROUP BY lower(entity_id), schema_name""",
    "in_flight": """
        SELECT DISTINCT lower(entity_id) AS entity_id FROM run_log
        WHERE entity_id IS NOT NULL
          AND batch_status = 'STARTED' AND job_status <> 'COMPLETED' AND subject_area = 'MAIN'
          AND batch_start_ts + INTERVAL 2160 HOUR >= TIMESTAMP '2001-06-01 00:00:00'""",
    "last_refresh": """
        SELECT lower(entity_id) AS entity_id,
               coalesce(max(src_refresh_ts), TIMESTAMP '1985-01-01 00:00:00') AS last_refreshed_ts
        FROM run_log
        WHERE batch_status <> 'FAILED' AND subject_area = 'MAIN' AND entity_id IS NOT NULL
          AND EXISTS (SELECT 1 FROM candidates c WHERE c.entity_id = lower(run_log.entity_id))
          AND NOT EXISTS (SELECT 1 FROM in_flight i WHERE i.entity_id = lower(run_log.entity_id))
        GROUP BY lower(entity_id)""",
    "registry_refresh": """
        SELECT lower(r.entity_id) AS entity_id, l.last_refreshed_ts, r.active_flag
        FROM (SELECT * FROM run_registry WHERE batch_id IN ('B1', 'B2') AND entity_id IS NOT NULL) r
        LEFT JOIN last_refresh l ON l.entity_id = lower(r.entity_id)""",
    "decisions": """
        SELECT c.*, l.last_refreshed_ts,
               CASE WHEN NOT k.registered THEN 'NEW'
                    WHEN NOT k.active THEN 'INACTIVE'
                    WHEN EXISTS (SELECT 1 FROM in_flight i WHERE i.entity_id = c.entity_id) THEN 'IN_FLIGHT'
                    WHEN l.last_refreshed_ts IS NULL THEN 'NO_HISTORY'
                    WHEN c.updated > l.last_refreshed_ts THEN 'REFRESH'
                    ELSE 'UP_TO_DATE' END AS decision
        FROM candidates c
        JOIN (SELECT entity_id, schema_name,
                     EXISTS (SELECT 1 FROM registry_refresh r WHERE r.entity_id = x.entity_id) AS registered,
                     EXISTS (SELECT 1 FROM registry_refresh r
                             WHERE r.entity_id = x.entity_id AND r.active_flag = 'Y') AS active
              FROM candidates x) k ON k.entity_id = c.entity_id AND k.schema_name = c.schema_name
        LEFT JOIN last_refresh l ON l.entity_id = c.entity_id AND k.registered""",
    "manifest": """
        SELECT 'run-1' AS run_id, CASE WHEN decision = 'NEW' THEN 0 ELSE 1 END AS run_order,
               entity_id, schema_name,
               CASE WHEN decision = 'NEW' THEN 'True' ELSE 'False' END AS new_entity_flag,
               CASE WHEN migrated = 'true' THEN 'True' ELSE 'False' END AS migrated,
               CAST(to_json(objects) AS VARCHAR) AS object_list,
               CASE WHEN date_trunc('second', updated) = updated THEN strftime(updated, '%Y-%m-%dT%H:%M:%S')
                    ELSE strftime(updated, '%Y-%m-%dT%H:%M:%S.%f') END AS updated,
               'stg' AS environment, 'B1' AS batch_id, 'Current' AS source_snapshot, 'False' AS debug_mode
        FROM decisions WHERE decision IN ('NEW', 'REFRESH')""",
    "decision_totals": """
        SELECT decision, count(*) AS n, CAST(ceil(count(DISTINCT entity_id) / 100.0) AS BIGINT) AS lines
        FROM decisions GROUP BY decision""",
    "outcomes": """
        SELECT entity_id, attempts_used,
               CASE WHEN ended_at IS NULL THEN 'EXHAUSTED'
                    WHEN ended_status = 200 THEN 'ACCEPTED'
                    ELSE 'REJECTED' END AS outcome
        FROM (SELECT entity_id,
                     min(attempt_no) FILTER (WHERE final) AS ended_at,
                     arg_min_null(status_code, CASE WHEN final THEN attempt_no ELSE 99 END) AS ended_status,
                     CAST(coalesce(min(attempt_no) FILTER (WHERE final), max(attempt_no)) AS INTEGER) AS attempts_used
              FROM (SELECT *, status_code IS NULL OR status_code NOT IN (429, 500, 502, 503, 504) AS final
                    FROM dispatch_attempts WHERE attempt_no <= 3)
              GROUP BY entity_id)""",
    "newest": """
        SELECT schema_name, coalesce(object_name, '') AS table_name, max(updated) AS newest
        FROM change_feed GROUP BY ALL""",
    "moved_control": """
        SELECT coalesce(c.schema_name, n.schema_name) AS schema_name,
               coalesce(c.table_name, n.table_name) AS table_name,
               c.entity_id,
               coalesce(c.created_timestamp, TIMESTAMP '2001-06-01 00:00:00') AS created_timestamp,
               CASE WHEN n.newest IS NULL THEN c.updated_timestamp
                    ELSE TIMESTAMP '2001-06-01 00:00:00' END AS updated_timestamp,
               coalesce(n.newest, c.last_modified_datetime) AS last_modified_datetime
        FROM control c FULL JOIN newest n ON c.schema_name = n.schema_name AND c.table_name = n.table_name""",
}

# What each relation is read from, in the order of definition.
_NEEDS = {
    "control": ["change_feed"],
    "watermarks": ["control"],
    "changed": ["change_feed"],
    "changed_by_source": ["watermarks"],
    "matched": ["changed", "readiness"],
    "matched_by_source": ["changed_by_source", "readiness"],
    "candidates": ["matched"],
    "in_flight": ["run_log"],
    "last_refresh": ["candidates", "in_flight"],
    "registry_refresh": ["run_registry", "last_refresh"],
    "decisions": ["registry_refresh"],
    "manifest": ["decisions"],
    "decision_totals": ["decisions"],
    "outcomes": ["dispatch_attempts"],
    "newest": ["change_feed"],
    "moved_control": ["control", "newest"],
}


# What a whole run does otherwise: its watermark is the stored one of the feed as a whole.
_RUN = {
    "changed": """
        SELECT * FROM change_feed WHERE updated > coalesce(
            (SELECT last_modified_datetime FROM control WHERE schema_name = 'meta' AND table_name = 'change_feed'),
            TIMESTAMP '1990-01-01 00:00:00')""",
}
# Object lists as Python writes them; no name of the fixture has a character to escape.
_PYTHON_LISTS = {
    "manifest": CTES["manifest"].replace(
        "CAST(to_json(objects) AS VARCHAR)",
        "concat('[', array_to_string(list_transform(objects, lambda x: concat(chr(39), x, chr(39))), ', '), ']')",
    )
}
_PAYLOAD = """
        SELECT *, CAST(json_object('job_id', 42, 'notebook_params', json_object(
                   'entity_id', entity_id, 'schema_name', schema_name, 'new_entity_flag', new_entity_flag,
                   'migrated', migrated, 'object_list', object_list, 'updated', updated,
                   'environment', environment, 'batch_id', batch_id, 'source_snapshot', source_snapshot,
                   'debug_mode', debug_mode)) AS VARCHAR) AS payload
        FROM manifest"""
_WHOLE_FEED = """
        SELECT schema_name, table_name, entity_id, created_timestamp,
               CASE WHEN schema_name = 'meta' THEN TIMESTAMP '2001-06-01 00:00:00'
                    ELSE updated_timestamp END AS updated_timestamp,
               CASE WHEN schema_name = 'meta' THEN (SELECT max(updated) FROM change_feed)
                    ELSE last_modified_datetime END AS last_modified_datetime
        FROM control"""


# A run over the sources of one schema, each with its own mark.
_LISTED = """
        SELECT f.* FROM change_feed f
        JOIN watermarks w ON w.schema_name = f.schema_name AND w.object_name = coalesce(f.object_name, '')
        WHERE w.schema_name = 'raw_o' AND f.updated > w.watermark"""
_LISTED_CONTROL = {
    "changed_by_source": _LISTED,
    "newest": """
        SELECT schema_name, coalesce(object_name, '') AS table_name, max(updated) AS newest
        FROM change_feed
        WHERE schema_name = 'raw_o' AND updated <= (SELECT max(updated) FROM changed_by_source) GROUP BY ALL""",
    "moved_control": CTES["moved_control"].replace(
        "coalesce(n.newest, c.last_modified_datetime)", "greatest(n.newest, c.last_modified_datetime)"
    ),
}


def _with(relation: str, select: str, **own: str) -> str:
    """``select`` over what ``relation`` needs; ``own`` holds other definitions of some of it."""
    wanted: set[str] = set()
    todo = [relation, *(["control"] if "changed" in own else []), *own]
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo.extend(_NEEDS.get(name, []))
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in {**CTES, **own}.items() if name in wanted)
    return f"WITH {ctes}\n{select}"


_CANDIDATE_COLUMNS = "entity_id, schema_name, array_to_string(objects, ',') AS object_list, migrated, updated"


def _grouped(relation: str) -> str:
    return f"""
        SELECT lower(entity_id) AS entity_id, schema_name,
               array_to_string(list_sort(list(DISTINCT object_name)), ',') AS object_list,
               CAST(bool_or(coalesce(migrated, FALSE)) AS VARCHAR) AS migrated,
               max(updated) AS updated
        FROM {relation} GROUP BY lower(entity_id), schema_name"""


def oracle_sql() -> dict[str, str]:
    return {
        "watermark_read": _with("watermarks", "SELECT * FROM watermarks"),
        "incremental_filter": _with("changed", "SELECT * FROM changed"),
        "incremental_filter_stored": _with(
            "control",
            """
        SELECT * FROM change_feed WHERE updated > coalesce(
            (SELECT last_modified_datetime FROM control WHERE schema_name = 'raw_o' AND table_name = 't_N2'),
            TIMESTAMP '1990-01-01 00:00:00')""",
        ),
        "incremental_filter_by_source": _with("changed_by_source", "SELECT * FROM changed_by_source"),
        "incremental_filter_listed": _with("watermarks", _LISTED),
        "incremental_candidates": _with("matched", _grouped("matched")),
        "incremental_candidates_by_source": _with("matched_by_source", _grouped("matched_by_source")),
        "incremental_candidates_raw": _with(
            "matched",
            """
        SELECT DISTINCT lower(entity_id) AS entity_id, schema_name,
               array_to_string(list_sort(list(DISTINCT object_name)), ',') AS object_list,
               CAST(coalesce(migrated, FALSE) AS VARCHAR) AS migrated,
               updated
        FROM matched GROUP BY matched.entity_id, schema_name, matched.migrated, updated""",
        ),
        "in_flight_runs": _with("in_flight", "SELECT * FROM in_flight"),
        "last_refresh": _with("last_refresh", "SELECT * FROM last_refresh"),
        "registry_last_refresh": _with(
            "registry_refresh",
            "SELECT * FROM registry_refresh ORDER BY last_refreshed_ts DESC NULLS LAST, entity_id",
        ),
        "new_entities": _with(
            "registry_refresh",
            f"SELECT {_CANDIDATE_COLUMNS} FROM candidates "
            "WHERE NOT EXISTS (SELECT 1 FROM registry_refresh r WHERE r.entity_id = candidates.entity_id)",
        ),
        "stale_entities": _with(
            "registry_refresh",
            f"SELECT {_CANDIDATE_COLUMNS} FROM candidates c WHERE EXISTS ("
            "SELECT 1 FROM registry_refresh r WHERE r.entity_id = c.entity_id "
            "AND r.active_flag = 'Y' AND c.updated > r.last_refreshed_ts)",
        ),
        "refresh_decision": _with(
            "decisions", f"SELECT {_CANDIDATE_COLUMNS}, last_refreshed_ts, decision FROM decisions"
        ),
        "run_manifest": _with("manifest", _PAYLOAD),
        "run_manifest_python": _with("manifest", _PAYLOAD, **_PYTHON_LISTS),
        "refresh_run_decisions": _with(
            "decisions", f"SELECT {_CANDIDATE_COLUMNS}, last_refreshed_ts, decision FROM decisions", **_RUN
        ),
        "refresh_run_control": _with("control", _WHOLE_FEED),
        "refresh_run_listed": _with("moved_control", "SELECT * FROM moved_control", **_LISTED_CONTROL),
        "manifest_summary": _with(
            "decision_totals",
            """
        SELECT d.decision, CAST(concat('0x', substr(md5(d.entity_id), 1, 8)) AS BIGINT) % t.lines AS line_no, t.n,
               string_agg(DISTINCT d.entity_id, ',' ORDER BY d.entity_id) AS entities
        FROM decisions d JOIN decision_totals t ON t.decision = d.decision GROUP BY ALL""",
        ),
        "dispatch_outcome": _with("outcomes", "SELECT * FROM outcomes"),
        "commit_gate": _with(
            "outcomes",
            "SELECT count(*) AS n, coalesce(bool_and(outcome = 'ACCEPTED'), FALSE) AS may_commit FROM outcomes",
        ),
        "next_watermark": _with("moved_control", "SELECT * FROM moved_control"),
        "next_watermark_whole_feed": _with("control", _WHOLE_FEED),
        "next_watermark_held": _with("control", "SELECT * FROM control"),
        "control_upsert": _with("moved_control", "SELECT * FROM moved_control"),
    }
