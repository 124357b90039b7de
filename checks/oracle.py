"""The registered queries as SQL on the plain tables.

Each text states what comes out of an operator by ``CASE``, joins and groups on
the table columns; bodies are sets of ``(k, rank, field, v)`` with ``v`` a JSON
literal.
"""

from __future__ import annotations

from checks.fixtures import BASE_URL, CHILD_TYPES, HINTS, VERSION_LABELS

# Template field types and the types they become.
TYPES = {
    "text-field": "text", "link-field": "text", "controlled-term-field": "categorical", "numeric-field": "number",
    "radio-field": "categorical", "checkbox-field": "categorical", "date-field": "text", "datetime-field": "text",
    "email-field": "text", "url-field": "text",
}


def _js(text: str) -> str:
    return f"CAST(to_json({text}) AS VARCHAR)"


BASE = """
b AS (
  SELECT o_orderkey AS k, o_orderpriority AS pr, o_orderstatus AS st,
    CAST(floor(o_totalprice) AS BIGINT) AS total, o_totalprice > 250000 AS large,
    CASE WHEN o_totalprice > 250000 THEN '1-URGENT' ELSE o_orderpriority END AS epr,
    c_mktsegment AS seg, r_name AS region, strftime(o_orderdate, '%Y-%m-%d') AS od,
    CASE o_orderkey % 5 WHEN 2 THEN '' WHEN 3 THEN '  '
      WHEN 4 THEN 'clerk-' || CAST(o_orderkey % 100 AS VARCHAR) END AS clerk,
    CASE o_orderkey % 3 WHEN 0 THEN 'LC-001' WHEN 1 THEN 'lc 1' ELSE 'LC-001' || chr(10) END AS code,
    'n' || CAST(o_orderkey % 10 AS VARCHAR) AS note,
    CASE WHEN o_orderstatus = 'O' AND c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'direct'
      WHEN o_orderstatus = 'F' AND c_mktsegment = 'FURNITURE' THEN 'store'
      WHEN o_orderstatus = 'P' AND c_mktsegment = 'HOUSEHOLD' THEN 'phone' END AS channel,
    'ORD' || CAST(o_orderkey AS VARCHAR) AS rid,
    replace(lower(r_name), ' ', '-') || '-' || lower(c_mktsegment) AS slug
  FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _body(name: str, members: list[tuple[str, str, str]]) -> str:
    """A CTE of cells from ``(field, value, condition)``."""
    parts = [
        f"SELECT k, {i} AS rank, '{field}' AS field, {value} AS v FROM b WHERE {when}"
        for i, (field, value, when) in enumerate(members, 1)
    ]
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


def _nullable(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'null' ELSE {_js(column)} END"


ORIGINAL = [
    ("order_priority", _js("pr"), "TRUE"),
    ("priority", "'\"OVERRIDE\"'", "k % 7 = 0"),
    ("order_status", _js("st"), "TRUE"),
    ("status_code", "'\"RAW\"'", "k % 11 = 0"),
    ("total", "CAST(total AS VARCHAR)", "TRUE"),
    ("is_large", "CASE WHEN large THEN 'true' ELSE 'false' END", "TRUE"),
    ("clerk", _nullable("clerk"), "k % 5 <> 0"),
    ("segment", _js("seg"), "TRUE"),
    ("order_date", _js("od"), "TRUE"),
    ("legacy_code", _js("code"), "TRUE"),
    ("note", _js("note"), "TRUE"),
]
RULED = [
    ("order_priority", _js("epr"), "TRUE"),
    *ORIGINAL[1:],
    ("channel", _js("channel"), "channel = 'direct'"),
    ("source_system", "'\"orders7\"'", "TRUE"),
    ("clerk_state", "'\"unknown\"'", "k % 5 IN (0, 1)"),
    ("expedite", "'\"true\"'", "pr = '1-URGENT'"),
    ("channel", _js("channel"), "channel IN ('store', 'phone')"),
]
RENAMED = [
    ("priority_level", _js("pr"), "TRUE"),
    ("status_code", "CASE WHEN k % 11 = 0 THEN '\"RAW\"' ELSE " + _js("st") + " END", "TRUE"),
    ("amount", "CAST(total AS VARCHAR)", "TRUE"),
    ("is_large_order", "CASE WHEN large THEN 'true' ELSE 'false' END", "TRUE"),
    ("clerk_name", _nullable("clerk"), "k % 5 <> 0"),
    ("segment", _js("seg"), "TRUE"),
    ("order_date", _js("od"), "TRUE"),
    ("code", _js("code"), "TRUE"),
    ("note", _js("note"), "TRUE"),
]


def _level(column: str) -> str:
    return (
        f"CASE {column} WHEN '1-URGENT' THEN '\"Urgent\"' WHEN '2-HIGH' THEN '\"High\"' "
        f"WHEN '3-MEDIUM' THEN '\"Medium\"' WHEN '4-NOT SPECIFIED' THEN 'null' ELSE '\"5-LOW\"' END"
    )


STATUS = "CASE WHEN k % 11 = 0 THEN '\"RAW\"' WHEN st = 'F' THEN '1' WHEN st = 'O' THEN '2' ELSE '[]' END"
LARGE = "CASE WHEN large THEN '\"Yes\"' ELSE '\"No\"' END"
CLERK = "CASE WHEN clerk IS NULL OR clerk = '' THEN 'null' ELSE " + _js("clerk") + " END"
STANDARD = [
    ("priority_level", _level("pr"), "TRUE"),
    ("status_code", STATUS, "TRUE"),
    RENAMED[2],
    ("is_large_order", LARGE, "TRUE"),
    ("clerk_name", CLERK, "k % 5 <> 0"),
    *RENAMED[5:],
]


def _schema_body(level: str, channel: str, expedite: str, source: str) -> list[tuple[str, str, str]]:
    return [
        ("priority_level", level, "TRUE"),
        ("status_code", STATUS, "TRUE"),
        ("amount", "CAST(total AS VARCHAR)", "TRUE"),
        ("is_large_order", LARGE, "TRUE"),
        ("clerk_name", f"CASE WHEN k % 5 = 0 THEN '\"nobody\"' ELSE {CLERK} END", "TRUE"),
        ("segment", _js("seg"), "TRUE"),
        ("order_date", _js("od"), "TRUE"),
        ("code", _js("code"), "TRUE"),
        ("channel", channel, "TRUE"),
        ("region", "'null'", "TRUE"),
        ("expedite", expedite, "TRUE"),
        ("source_system", source, "TRUE"),
    ]


CONFORMED = _schema_body(_level("pr"), "'\"unknown\"'", "'null'", "'null'")
HARMONIZED = _schema_body(
    _level("epr"),
    "CASE WHEN channel IS NULL THEN '\"unknown\"' ELSE " + _js("channel") + " END",
    "CASE WHEN pr = '1-URGENT' THEN '\"true\"' ELSE 'null' END",
    "'\"orders7\"'",
)
EXCLUDED = [("note", _js("note"), "TRUE"), ("clerk_state", "'\"unknown\"'", "k % 5 IN (0, 1)")]

CELLS = """SELECT k AS id, row_number() OVER (PARTITION BY k ORDER BY rank) - 1 AS pos, field, v AS value_json FROM """


def _cells(members) -> str:
    return f"WITH {BASE}, {_body('body', members)} {CELLS} body"


RENAME_LOG = """
renames AS (
  SELECT k, 1 AS rank, 'order_priority' AS legacy, 'priority_level' AS target FROM b
  UNION ALL SELECT k, 2, 'order_status', 'status_code' FROM b
  UNION ALL SELECT k, 3, 'total', 'amount' FROM b
  UNION ALL SELECT k, 4, 'is_large', 'is_large_order' FROM b
  UNION ALL SELECT k, 5, 'clerk', 'clerk_name' FROM b WHERE k % 5 <> 0
  UNION ALL SELECT k, 6, 'legacy_code', 'code' FROM b)"""


def _value_log(priority: str) -> str:
    return f"""
value_log AS (
  SELECT k, 1 AS rank, 'priority_level' AS field, {priority} AS old, {_level(priority)} AS new FROM b
    WHERE {priority} <> '5-LOW'
  UNION ALL SELECT k, 2, 'status_code', st, {STATUS} FROM b WHERE k % 11 <> 0
  UNION ALL SELECT k, 3, 'is_large_order', CASE WHEN large THEN 'True' ELSE 'False' END, {LARGE} FROM b
  UNION ALL SELECT k, 4, 'clerk_name', '', 'null' FROM b WHERE k % 5 = 2)"""


DIFF = f"""
{_body('old', ORIGINAL)}, {_body('new', HARMONIZED)},
diff AS (
  SELECT coalesce(n.k, o.k) AS k,
    CASE WHEN o.k IS NULL THEN 'add' WHEN n.k IS NULL THEN 'remove' ELSE 'replace' END AS op,
    '/' || coalesce(n.field, o.field) AS path, n.v AS v
  FROM old o FULL JOIN new n ON o.k = n.k AND o.field = n.field
  WHERE o.v IS DISTINCT FROM n.v)"""

# Issues of the harmonized orders.
ISSUES = """
np AS (
  SELECT k, 'priority_level' AS field, '5-LOW' AS value FROM b WHERE epr = '5-LOW'
  UNION ALL SELECT k, 'status_code', CASE WHEN k % 11 = 0 THEN 'RAW' ELSE '[]' END FROM b
    WHERE k % 11 = 0 OR st = 'P'
  UNION ALL SELECT k, 'segment', seg FROM b WHERE seg = 'FURNITURE'),
mr AS (
  SELECT k, 'priority_level' AS field, 'null' AS value FROM b WHERE epr = '4-NOT SPECIFIED'
  UNION ALL SELECT k, 'clerk_name', CASE WHEN k % 5 = 3 THEN '' ELSE 'null' END FROM b WHERE k % 5 IN (1, 2, 3)
  UNION ALL SELECT k, 'region', 'null' FROM b),
rx AS (SELECT k, 'code' AS field, code AS value FROM b WHERE NOT regexp_full_match(code, 'LC-[0-9]{3}')),
typed AS (
  SELECT *, 'non_permissible' AS issue_type FROM np UNION ALL SELECT *, 'missing_required' FROM mr
  UNION ALL SELECT *, 'regex_violations' FROM rx)"""
MERGED = "merged AS (SELECT DISTINCT k, field, value FROM typed)"


def _issues(part: str) -> str:
    return f"WITH {BASE}, {ISSUES}, {MERGED} SELECT k AS id, field, value FROM {part}"


def _review(kind: str, columns: str) -> str:
    return f"""WITH {BASE}, {ISSUES},
rows AS (SELECT slug, rid, field, min(value) AS value FROM typed JOIN b USING (k)
  WHERE issue_type = '{kind}' GROUP BY slug, rid, field)
SELECT slug AS group_slug, rid AS dataset_id, field AS field_name, {columns}
  '{BASE_URL}' || rid AS dataset_url FROM rows"""


EVENTS = """
e AS (SELECT event_id AS id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS n FROM events)"""
SCORE = "CASE n WHEN 0 THEN 'null' WHEN 1 THEN '\"one\"' ELSE CAST(n AS VARCHAR) END"
PART = "p AS (SELECT p_partkey AS k, p_brand AS profile, p_type AS type, p_size AS size, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS key FROM part)"
CROSSWALK = PART + """,
cw AS (
  SELECT profile, k, 1 AS row_no, 1 AS col_no, 'size_' || (k % 4) AS target, 'size' AS legacy FROM p
  UNION ALL SELECT profile, k, 1, 2, 'size_' || (k % 4), 'p_size_' || (k % 9) FROM p
  UNION ALL SELECT profile, k, 2, 1, '  name ', ' label_' || (k % 6) || ' ' FROM p
  UNION ALL SELECT profile, k, 2, 2, '  name ', '' FROM p
  UNION ALL SELECT profile, k, 3, 1, CASE WHEN k % 5 < 2 THEN '' ELSE 'note_text' END, '' FROM p
  UNION ALL SELECT profile, k, 3, 2, CASE WHEN k % 5 < 2 THEN '' ELSE 'note_text' END, 'note_' || (k % 5) FROM p
  UNION ALL SELECT profile, k, 4, 1, 'disk', '5" disk' FROM p
  UNION ALL SELECT profile, k, 4, 2, 'disk', '3" lbl' FROM p
  UNION ALL SELECT profile, k, 5, 1, 'two' || chr(10) || 'lines"', 'a"b' FROM p
  UNION ALL SELECT profile, k, 5, 2, 'two' || chr(10) || 'lines"', 'cd' FROM p
  UNION ALL SELECT profile, k, 6, 1, 'kind, ' || type, 'type_of' FROM p
  UNION ALL SELECT profile, k, 6, 2, 'kind, ' || type, 'the "type"' FROM p
  UNION ALL SELECT profile, k, 7, 1, 'only_' || k, NULL FROM p),
crosswalk AS (
  SELECT profile, 'cw/' || lpad(CAST(k AS VARCHAR), 12, '0') || '.csv' AS source_file, row_no, col_no,
    CASE col_no WHEN 1 THEN 'v0' ELSE 'v1' END AS schema_version, target, legacy FROM cw)"""


def _choices() -> str:
    lists = {
        "priority_level": [("string", v) for v in ("Urgent", "High", "Medium", "Low")],
        "segment": [("string", v) for v in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")],
        "status_code": [("integer", "1"), ("integer", "2")],
    }
    rows = ", ".join(
        f"('{f}', {i}, '{kind}', '{v}')" for f, vs in lists.items() for i, (kind, v) in enumerate(vs, 1)
    )
    return f"""WITH {BASE}, {ISSUES}, allowed(field, row_no, kind, value) AS (VALUES {rows}),
fields AS (SELECT DISTINCT slug, field FROM typed JOIN b USING (k) WHERE field IN (SELECT field FROM allowed))
SELECT slug AS group_slug, f.field, dense_rank() OVER (PARTITION BY slug ORDER BY f.field) AS col_no,
  row_no, kind, value FROM fields f JOIN allowed a ON f.field = a.field"""


def _templates() -> str:
    kinds = ", ".join(f"({i}, '{t}', '{TYPES.get(t, 'text')}')" for i, t in enumerate(CHILD_TYPES))
    return f"""WITH kinds(i, source_type, type) AS (VALUES {kinds}),
c AS (SELECT c_custkey AS k, c_mktsegment AS seg, source_type, type FROM customer JOIN kinds ON c_custkey % 11 = i)
SELECT 'template-' || k AS profile, 0 AS pos, CASE WHEN k % 4 = 0 THEN 'k' || k ELSE 'n' || k END AS name,
  'about ' || k AS description, type, '^a$' AS regex,
  CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END AS required_json,
  CASE k % 5 WHEN 0 THEN '"plain"' WHEN 1 THEN
      CASE WHEN source_type = 'controlled-term-field' THEN '"L"' ELSE '"V"' END
    WHEN 2 THEN '7' WHEN 3 THEN '2.5' ELSE 'null' END AS default_json,
  CASE WHEN source_type NOT IN ('controlled-term-field', 'radio-field', 'checkbox-field') THEN NULL
    WHEN k % 3 = 0 THEN '["' || seg || '","T",7]' WHEN k % 3 = 1 THEN '["s",' || (k % 10) || ',1.5]' END
    AS permissible_json
FROM c
UNION ALL SELECT 'template-' || k, 3, 'last', '', 'text', NULL, 'false', 'null', NULL FROM c"""


def oracle_sql() -> dict[str, str]:
    label = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VERSION_LABELS.items())
    log_count = "CASE WHEN id % 10 IN (7, 8, 9) THEN 1 + CASE WHEN n IN (0, 1, 2) THEN 1 ELSE 0 END ELSE 0 END"
    ok = "id % 10 IN (3, 5, 7, 8, 9)"
    agg = "string_agg({0}, ',' ORDER BY {1})"

    def grouped(name: str, source: str, item: str, order: str) -> str:
        return f"{name} AS (SELECT k, {agg.format(item, order)} AS t FROM {source} GROUP BY k)"

    member = _js("field") + " || ':' || v"
    texts = {
        "harmonize_orders": _cells(HARMONIZED),
        "harmonize_profiles": f"""WITH {BASE}, {_body('old', ORIGINAL)}, body AS (
            SELECT k, 'east' AS profile, 1 AS rank, 'level' AS field, {_js('pr')} AS v FROM b WHERE k % 3 = 0
            UNION ALL SELECT k, 'east', 2, 'state', CASE st WHEN 'O' THEN '"O"' ELSE '"done"' END FROM b WHERE k % 3 = 0
            UNION ALL SELECT k, 'east', 3, 'site', '"E1"' FROM b WHERE k % 3 = 0
            UNION ALL SELECT k, 'west', 1, 'state', CASE seg WHEN 'BUILDING' THEN '"Building"' ELSE {_js('seg')} END
              FROM b WHERE k % 3 = 1
            UNION ALL SELECT k, 'west', 2, 'urgency', {_js('pr')} FROM b WHERE k % 3 = 1
            UNION ALL SELECT k, 'none', rank, field, v FROM old WHERE k % 3 = 2)
            SELECT k AS id, profile, row_number() OVER (PARTITION BY k ORDER BY rank) - 1 AS pos, field,
              v AS value_json FROM body""",
        "harmonize_without_phases": _cells(ORIGINAL),
        "apply_rules_orders": _cells(RULED),
        "applied_rule_log": f"""WITH {BASE}
            SELECT k AS id, 1 AS rule_no, 'channel' AS field, '"direct"' AS value_json FROM b WHERE channel = 'direct'
            UNION ALL SELECT k, 2, 'source_system', '"orders"' FROM b
            UNION ALL SELECT k, 3, 'clerk_state', '"unknown"' FROM b WHERE k % 5 IN (0, 1)
            UNION ALL SELECT k, 4, 'order_priority', '"1-URGENT"' FROM b WHERE large
            UNION ALL SELECT k, 5, 'expedite', '"true"' FROM b WHERE pr = '1-URGENT'
            UNION ALL SELECT k, 7, 'source_system', '"orders7"' FROM b
            UNION ALL SELECT k, 8, 'channel', '"store"' FROM b WHERE channel = 'store'
            UNION ALL SELECT k, 9, 'channel', '"phone"' FROM b WHERE channel = 'phone'""",
        "rule_coverage": f"""WITH {BASE}, fired AS (
            SELECT region, 1 AS rule_no FROM b WHERE channel = 'direct'
            UNION ALL SELECT region, 2 FROM b UNION ALL SELECT region, 3 FROM b WHERE k % 5 IN (0, 1)
            UNION ALL SELECT region, 4 FROM b WHERE large UNION ALL SELECT region, 5 FROM b WHERE pr = '1-URGENT'
            UNION ALL SELECT region, 7 FROM b UNION ALL SELECT region, 8 FROM b WHERE channel = 'store'
            UNION ALL SELECT region, 9 FROM b WHERE channel = 'phone')
            SELECT rule_no, region AS group_name, count(*) AS n FROM fired GROUP BY rule_no, region""",
        "rename_fields_orders": _cells(RENAMED),
        "rename_log": f"""WITH {BASE}, {RENAME_LOG}
            SELECT k AS id, row_number() OVER (PARTITION BY k ORDER BY rank) - 1 AS pos, legacy, target FROM renames""",
        "standardize_values_orders": _cells(STANDARD),
        "value_mapping_log": f"WITH {BASE}, {_value_log('pr')} SELECT k AS id, field, old, new AS new_json FROM value_log",
        "ambiguous_log": f"""WITH {BASE} SELECT k AS id, 'priority_level' AS field, '"5-LOW"' AS value_json,
            '["Low","Lowest"]' AS options_json FROM b WHERE pr = '5-LOW'""",
        "conform_orders": _cells(CONFORMED),
        "excluded_orders": _cells(EXCLUDED),
        "diff_orders": f"""WITH {BASE}, {DIFF}
            SELECT k AS id, row_number() OVER (PARTITION BY k ORDER BY op, path) - 1 AS seq, op, path,
              v AS value_json FROM diff""",
        "output_json_orders": f"""WITH {BASE}, {DIFF}, {RENAME_LOG}, {_value_log('epr')}, {_body('out_of_schema', EXCLUDED)},
            {grouped('t_old', 'old', member, 'rank')}, {grouped('t_new', 'new', member, 'rank')},
            {grouped('t_diff', 'diff', '''CASE op WHEN 'remove' THEN '{"op":"remove","path":"' || path || '"}'
              ELSE '{"op":"' || op || '","path":"' || path || '","value":' || v || '}' END''', 'op, path')},
            {grouped('t_names', 'renames', _js('legacy') + " || ':' || " + _js('target'), 'rank')},
            {grouped('t_values', 'value_log', _js('field') + " || ':{' || " + _js('old') + " || ':' || new || '}'", 'rank')},
            {grouped('t_out', 'out_of_schema', member, 'rank')}
            SELECT b.k AS id, '{{"uuid":"' || b.k || '","record_id":"' || rid || '","status":"' ||
              CASE st WHEN 'F' THEN 'Published' ELSE 'QA' END || '","group_name":"' || region ||
              '","dataset_type":"' || seg || '","metadata":{{' || t_old.t || '}},"modified_metadata":{{' || t_new.t ||
              '}},"json_patch":[' || t_diff.t || '],"processing_log":{{"field_mappings":{{' || t_names.t ||
              '}},"value_mappings":{{' || t_values.t || '}},"ambiguous_mappings":[' ||
              CASE epr WHEN '5-LOW' THEN
                '{{"field":"priority_level","value":"5-LOW","permissible_values":["Low","Lowest"]}}' ELSE '' END ||
              '],"excluded_data":{{' || t_out.t || '}}}}}}' AS document
            FROM b JOIN t_old USING (k) JOIN t_new USING (k) JOIN t_diff USING (k) JOIN t_names USING (k)
              JOIN t_values USING (k) JOIN t_out USING (k)""",
        "props_documents": f"""WITH {EVENTS} SELECT id, CAST(id AS VARCHAR) AS uuid, event_type AS group_name,
            0 AS pos, 'score' AS field, {SCORE} AS value_json FROM e""",
        "parsed_bodies": f"""WITH {EVENTS} SELECT id, CASE id % 10 WHEN 3 THEN '{{}}' WHEN 5 THEN '{{"a":2,"b":5}}'
            ELSE '{{"k":' || n || '}}' END AS body FROM e WHERE {ok}""",
        "output_json_events": f"""WITH {EVENTS} SELECT id, '{{"uuid":"' || id || '","group_name":"' || event_type ||
            '","metadata":{{"k":' || n || '}},"modified_metadata":{{"score":' || {SCORE} ||
            '}},"json_patch":[{{"op":"add","path":"/score","value":' || {SCORE} ||
            '}},{{"op":"remove","path":"/k"}}],"processing_log":{{"field_mappings":{{"k":"score"}},"value_mappings":{{' ||
            CASE WHEN n IN (0, 1) THEN '"score":{{"' || n || '":' || {SCORE} || '}}' ELSE '' END ||
            '}},"ambiguous_mappings":[' ||
            CASE n WHEN 2 THEN '{{"field":"score","value":2,"permissible_values":["two","deux"]}}' ELSE '' END ||
            '],"excluded_data":{{}}}}}}' AS document FROM e""",
        "dead_letters": f"""WITH {EVENTS}, f AS (SELECT CASE WHEN id % 10 IN (0, 6) THEN 'invalid JSON'
              WHEN id % 10 = 1 THEN 'input must contain a JSON object' ELSE 'metadata is not a JSON object' END AS error
            FROM e WHERE NOT ({ok}))
            SELECT 'failed' AS status, error, count(*) AS n FROM f GROUP BY error""",
        "run_totals": f"""WITH {EVENTS} SELECT count(*) AS files, count_if({ok}) AS successful,
            count_if(NOT ({ok})) AS failed, count_if({ok}) AS objects_processed,
            CAST(sum({log_count}) AS BIGINT) AS log_entries FROM e""",
        "crosswalk_rows": f"WITH {CROSSWALK} SELECT * FROM crosswalk",
        "crosswalk_map": f"""WITH {CROSSWALK}, m AS (
            SELECT profile, trim(legacy) AS legacy, trim(target) AS target, source_file, row_no, col_no,
              row_number() OVER (PARTITION BY profile, trim(legacy) ORDER BY source_file, row_no, col_no) AS first,
              row_number() OVER (PARTITION BY profile, trim(legacy)
                ORDER BY source_file DESC, row_no DESC, col_no DESC) AS last
            FROM crosswalk WHERE trim(target) <> '' AND trim(legacy) <> '')
            SELECT a.profile, a.legacy, z.target, a.source_file, a.row_no, a.col_no
            FROM m a JOIN m z ON a.profile = z.profile AND a.legacy = z.legacy AND a.first = 1 AND z.last = 1""",
        "crosswalk_unmapped": f"""WITH {CROSSWALK} SELECT DISTINCT profile, trim(legacy) AS legacy FROM crosswalk c
            WHERE trim(legacy) <> '' AND NOT EXISTS (SELECT 1 FROM crosswalk d WHERE d.profile = c.profile
              AND trim(d.legacy) = trim(c.legacy) AND trim(d.target) <> '')""",
        "mapping_matrix": f"""WITH {CROSSWALK} SELECT profile, source_file, row_no, col_no,
            CASE schema_version {label} ELSE schema_version END AS version_label, legacy, target FROM crosswalk""",
        "merged_field_map": f"""WITH {PART}, m AS (
            SELECT profile, k, 'size' AS legacy, 'size_' || (k % 4) AS target FROM p
            UNION ALL SELECT profile, k, 'name_' || (k % 7), 'name' FROM p
            UNION ALL SELECT profile, k, 'drop_' || (k % 3), CASE WHEN k % 2 = 0 THEN NULL ELSE 'kept' END FROM p)
            SELECT profile, legacy, target FROM m
            QUALIFY row_number() OVER (PARTITION BY profile, legacy ORDER BY k) = 1""",
        "value_map_table": f"""WITH {PART}, r AS (
            SELECT profile, max(CASE WHEN k % 7 = 0 OR k % 3 = 0 THEN k END) AS replaced_at FROM p GROUP BY profile),
            pairs AS (
              SELECT profile, k, CAST(k % 5 AS VARCHAR) AS legacy_key, FALSE AS is_list, '["g' || size || '"]' AS t
                FROM p WHERE k % 7 <> 0 AND k % 3 = 0
              UNION ALL SELECT profile, k, 'x', TRUE, '[1,2.5,"a"]' FROM p WHERE k % 7 <> 0 AND k % 3 = 0
              UNION ALL SELECT profile, k, CAST(k % 6 AS VARCHAR), FALSE, '[' || size || ']'
                FROM p WHERE k % 7 <> 0 AND k % 3 <> 0
              UNION ALL SELECT profile, k, 'f', FALSE, '[35.0]' FROM p WHERE k % 7 <> 0 AND k % 3 <> 0
              UNION ALL SELECT profile, k, 'n', FALSE, '[null]' FROM p WHERE k % 7 <> 0 AND k % 3 <> 0),
            live AS (SELECT pairs.* FROM pairs JOIN r USING (profile) WHERE replaced_at IS NULL OR k >= replaced_at
              QUALIFY row_number() OVER (PARTITION BY profile, legacy_key ORDER BY k DESC) = 1)
            SELECT r.profile, 'grade' AS field, legacy_key, coalesce(is_list, FALSE) AS is_list,
              coalesce(t, '[]') AS options_json FROM r LEFT JOIN live ON r.profile = live.profile""",
        "rule_table": """WITH s AS (SELECT s_suppkey AS k, s_nationkey AS nation,
              'rules/' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') || '.json' AS source_file FROM supplier)
            SELECT 'nation-' || nation AS profile, source_file, 0 AS pos,
              '{"__must__":[{"nation":' || nation || '}]}' AS "when", '{"zone":"z' || (k % 3) || '"}' AS "then"
            FROM s WHERE k % 3 <> 0
            UNION ALL SELECT 'nation-' || nation, source_file, 1, '{}', '{"seen":true}' FROM s WHERE k % 3 = 2""",
        "schema_table": f"""WITH {PART}
            SELECT 'part-' || k AS profile, 0 AS pos, 'size' AS name, '' AS description, 'text' AS type,
              k % 2 = 0 AS required, FALSE AS required_strict, '\\d+' AS regex, 'null' AS default_json,
              NULL AS permissible_json FROM p
            UNION ALL SELECT 'part-' || k, 3, 'brand', '', 'text', FALSE, FALSE, NULL, 'null',
              '["' || profile || '",' || (k % 5) || ',1.5]' FROM p""",
        "template_schema": _templates(),
        "unmapped_values": f"""WITH {BASE}, v AS (
            SELECT 'status_code' AS field, 'RAW' AS value FROM b WHERE k % 11 = 0
            UNION ALL SELECT 'clerk_name', clerk FROM b WHERE k % 5 IN (3, 4)
            UNION ALL SELECT 'segment', seg FROM b)
            SELECT field, value, count(*) AS n FROM v GROUP BY field, value""",
        "validate_values": f"""WITH {BASE}, {_body('body', HARMONIZED)} SELECT k AS id, field,
            CASE field WHEN 'priority_level' THEN v IN ('"Urgent"', '"High"', '"Medium"', '"Low"')
              WHEN 'status_code' THEN v IN ('1', '2') WHEN 'is_large_order' THEN v IN ('"Yes"', '"No"')
              WHEN 'segment' THEN v <> '"FURNITURE"' ELSE TRUE END AS valid FROM body""",
        "schema_facets": f"""WITH {BASE}, {_body('body', RENAMED)} SELECT k AS id, field,
            field IN ('priority_level', 'amount', 'is_large_order', 'clerk_name', 'order_date') AS required,
            CASE field WHEN 'clerk_name' THEN '"nobody"' ELSE 'null' END AS default_json FROM body""",
        "nonpermissible": _issues("np"),
        "missing_required": _issues("mr"),
        "missing_before_conform": f"""WITH {BASE} SELECT k AS id, 'region' AS field, 'MISSING_FIELD' AS value FROM b
            UNION ALL SELECT k, 'clerk_name', CASE k % 5 WHEN 0 THEN 'MISSING_FIELD' WHEN 1 THEN 'null' ELSE '' END
            FROM b WHERE k % 5 <> 4""",
        "regex_violations": _issues("rx"),
        "merged_issues": _issues("merged"),
        "nonstandard_values": f"WITH {BASE}, {ISSUES}, {MERGED} SELECT DISTINCT field, value FROM merged",
        "quality_counts": f"""WITH {BASE}, {ISSUES}, {MERGED} SELECT
            (SELECT count(*) FROM b) AS documents_processed,
            (SELECT count(DISTINCT k) FROM np) AS documents_with_non_standard_values,
            (SELECT count(DISTINCT k) FROM mr) AS documents_with_missing_required_values,
            (SELECT count(DISTINCT k) FROM rx) AS documents_with_invalid_patterns,
            (SELECT count(*) FROM (SELECT DISTINCT field, value FROM merged)) AS total_values""",
        "group_summary": f"""WITH {BASE}, {ISSUES} SELECT slug AS group_slug, min(region) AS group_name,
            min(seg) AS dataset_type,
            count(DISTINCT CASE WHEN issue_type = 'non_permissible' THEN rid END) AS datasets_with_non_standard_values,
            count(DISTINCT CASE WHEN issue_type = 'missing_required' THEN rid END) AS datasets_with_missing_required_values,
            count(DISTINCT CASE WHEN issue_type = 'regex_violations' THEN rid END) AS datasets_with_invalid_input_patterns,
            count(DISTINCT CASE WHEN issue_type IS NOT NULL THEN rid END) AS total_datasets_with_issues
            FROM b LEFT JOIN typed USING (k) GROUP BY slug""",
        "issue_rows": f"""WITH {BASE}, {ISSUES} SELECT slug AS group_slug, region AS group_name, seg AS dataset_type,
            rid AS record_id, issue_type, field, value FROM typed JOIN b USING (k)""",
        "review_nonstandard": _review("non_permissible", "value AS current_value, '' AS new_value,"),
        "review_missing": _review("missing_required", "'' AS new_value,"),
        "review_pattern": _review(
            "regex_violations",
            f"value AS current_value, '' AS new_value, CASE field WHEN 'code' THEN '{HINTS['code']}' ELSE '' END"
            " AS expected_input_hint,",
        ),
        "choice_lists": _choices(),
        "value_mapping_catalog": f"""WITH {BASE}, {_value_log('epr')} SELECT DISTINCT field, old AS old_value,
            CASE WHEN new = 'null' THEN 'None' ELSE trim(new, '"') END AS new_value,
            new IN ('1', '2') AS new_value_is_numeric FROM value_log""",
        "report_counts": f"""WITH {BASE}, {CROSSWALK} SELECT profile, count(*) AS field_mappings,
              0 AS value_mappings, 0 AS rules FROM crosswalk WHERE col_no = 1 GROUP BY profile
            UNION ALL SELECT 'east', 0, 1, 1 FROM b WHERE k % 3 = 0 AND st <> 'O' GROUP BY 1
            UNION ALL SELECT 'west', 0, 1, 0 FROM b WHERE k % 3 = 1 AND seg = 'BUILDING' GROUP BY 1""",
    }
    texts["conform_catalog"] = f"""WITH {PART}
        SELECT k AS id, 0 AS pos, 'size' AS field, CAST(size AS VARCHAR) AS value_json FROM p
        UNION ALL SELECT k, 1, 'brand', CASE WHEN k % 2 = 0 THEN {_js('profile')} ELSE 'null' END FROM p"""
    texts |= _catalogs() | _nested() | _broken_config()
    distinct = "SELECT NULL::VARCHAR AS profile, field, value FROM (SELECT DISTINCT field, value FROM merged)"
    texts["nonstandard_json"] = _value_lists(f"{BASE}, {ISSUES}, {MERGED}", distinct, "")
    # The same maps looked up by join give the same results.
    for name in ("rename_fields_orders", "standardize_values_orders", "unmapped_values", "harmonize_profiles", "conform_orders",
                 "missing_before_conform", "apply_rules_orders", "regex_violations", "nonpermissible"):
        texts[f"{name}_joined"] = texts[name]
    texts["quality_run"], texts["quality_run_review"] = texts["group_summary"], texts["review_pattern"]
    texts["stream_totals"], texts["stream_dead_letters"] = texts["run_totals"], texts["dead_letters"]
    return texts


def _catalogs() -> dict[str, str]:
    """Parts by rules and schemas of their own."""
    q = """q AS (SELECT p_partkey AS k, p_type AS type, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand, p_brand,
             p_size AS size, 'P' || p_partkey AS rid, replace(lower(p_brand), ' ', '-') || '-' || lower(p_type) AS slug,
             'part-' || p_partkey AS profile FROM part),
           m AS (SELECT *, type IN ('SMALL', 'ECONOMY') AND (brand IS NULL OR k % 4 = 0) AS nested,
             type = 'ECONOMY' OR (type = 'SMALL' AND brand IS NOT NULL) AS crossed, k % 3 = 1 AS seen,
             brand IS NULL AND type = 'SMALL' AS unknown, size = 7 AS lucky FROM q)"""
    own = """SELECT k, 1 AS no, 'nested' AS rule FROM m WHERE nested
             UNION ALL SELECT k, 3, 'seen' FROM m WHERE seen
             UNION ALL SELECT k, CASE WHEN seen THEN 4 ELSE 3 END, 'crossed' FROM m WHERE crossed"""
    shared = """SELECT k, 1 AS no, 'lucky' AS rule FROM m WHERE lucky UNION ALL SELECT k, 2, 'source' FROM m
             UNION ALL SELECT k, 3, 'unknown' FROM m WHERE unknown"""
    updates = """CASE rule WHEN 'nested' THEN '{"zone": "z' || k % 3 || '", "n": ' || k || '}' WHEN 'seen' THEN '{"seen": true}'
             WHEN 'crossed' THEN '{"type": "T' || k % 5 || '", "brand": "none"}' WHEN 'lucky' THEN '{"lucky": true}'
             WHEN 'source' THEN '{"source": "parts"}' ELSE '{"brand_state": "unknown"}' END"""
    body = """cells AS (
        SELECT k, 1 AS rank, 'type' AS field, CASE WHEN crossed THEN '"T' || k % 5 || '"' ELSE '"' || type || '"' END AS v FROM m
        UNION ALL SELECT k, 2, 'brand', CASE WHEN crossed THEN '"none"' ELSE '"' || brand || '"' END FROM m WHERE brand IS NOT NULL
        UNION ALL SELECT k, 3, 'size', size::VARCHAR FROM m
        UNION ALL SELECT k, 4, 'lucky', 'true' FROM m WHERE lucky
        UNION ALL SELECT k, 5, 'source', '"parts"' FROM m
        UNION ALL SELECT k, 6, 'brand_state', '"unknown"' FROM m WHERE unknown
        UNION ALL SELECT k, 7, 'zone', '"z' || k % 3 || '"' FROM m WHERE nested
        UNION ALL SELECT k, 8, 'n', k::VARCHAR FROM m WHERE nested
        UNION ALL SELECT k, 9, 'seen', 'true' FROM m WHERE seen
        UNION ALL SELECT k, 10, 'brand', '"none"' FROM m WHERE crossed AND brand IS NULL)"""
    wrong = """np AS (
        SELECT k, 'type' AS field, type AS value FROM q WHERE type NOT IN ('SMALL', 'ECONOMY')
        UNION ALL SELECT k, 'brand', brand FROM q WHERE brand IS NOT NULL AND (k % 6 = 0 OR (brand <> 'Brand#1' AND k % 6 <> 2)))"""
    # Sizes are on their list as text or number; as values only where the list has the number, or 1 as true.
    broken = """rx AS (
        SELECT k, 'type' AS field, type AS value FROM q WHERE NOT regexp_full_match(type, '(SMALL|ECONOMY){1,' || (1 + k % 9) || '}')
        UNION ALL SELECT k, 'size', size::VARCHAR FROM q
        WHERE CASE k % 5 WHEN 0 THEN size >= 40 WHEN 1 THEN size >= 10 WHEN 4 THEN size < 10 ELSE FALSE END)"""
    missing = "mr AS (SELECT k, 'brand' AS field, 'MISSING_FIELD' AS value FROM q WHERE brand IS NULL)"
    listed = """SELECT DISTINCT p_brand AS profile, field, value FROM (FROM np UNION ALL FROM rx UNION ALL FROM mr) JOIN q USING (k)
        UNION ALL SELECT p_brand, 'id', rid FROM q"""
    return {
        "nonstandard_json_catalog": _value_lists(f"{q}, {wrong}, {broken}, {missing}", listed, "profile, "),
        "rules_catalog": f"""WITH {q}, {body} SELECT k AS id, row_number() OVER (PARTITION BY k ORDER BY rank) - 1 AS pos,
            field, v AS value_json FROM cells""",
        "fired_rules_catalog": f"""WITH {q} SELECT k AS id, no AS rule_no, 'rules/' || k || '.json' AS source_file, {updates} AS updates
            FROM ({own}) UNION ALL SELECT k, no, 'rules/all.json', {updates} FROM ({shared})""",
        "rule_coverage_catalog": f"""WITH {q} SELECT no AS rule_no, p_brand AS group_name, count(*) AS n
            FROM ({shared}) JOIN q USING (k) GROUP BY no, p_brand""",
        "nonpermissible_catalog": f"WITH {q}, {wrong} SELECT k AS id, field, value FROM np",
        "validate_catalog": f"""WITH {q}, {wrong} SELECT k AS id, field, NOT EXISTS (FROM np WHERE np.k = c.k AND np.field = c.field)
              AND NOT (field = 'size' AND k % 2 = 1 AND size <> 1) AS valid
            FROM (SELECT k, size, 'type' AS field FROM q UNION ALL SELECT k, size, 'size' FROM q
                  UNION ALL SELECT k, size, 'brand' FROM q WHERE brand IS NOT NULL) c""",
        "facets_catalog": f"""WITH {q} SELECT k AS id, 'type' AS field, TRUE AS required, 'null' AS default_json FROM q
            UNION ALL SELECT k, 'brand', TRUE, 'null' FROM q WHERE brand IS NOT NULL
            UNION ALL SELECT k, 'size', FALSE, k::VARCHAR FROM q""",
        "patterns_catalog": f"""WITH {q}, {broken} SELECT k AS id, field, value, 'violation' AS result FROM rx
            UNION ALL SELECT k, 'size', '(', 'not checkable' FROM q WHERE k % 5 = 2""",
        "choice_lists_catalog": f"""WITH {q}, {wrong}, {broken}, {missing}, f AS (
              SELECT DISTINCT k, field FROM (FROM np UNION ALL FROM rx UNION ALL FROM mr) WHERE NOT (field = 'brand' AND k % 6 = 0)
            ), n AS (SELECT f.k, field, dense_rank() OVER (PARTITION BY f.k ORDER BY field) AS col_no FROM f),
            v AS (SELECT k, 'type' AS field, unnest([('string', 'SMALL'), ('string', 'ECONOMY'), ('integer', (k % 7)::VARCHAR)]) AS x,
                    unnest([1, 2, 3]) AS row_no FROM q
              UNION ALL SELECT k, 'brand', unnest(CASE WHEN k % 6 = 2 THEN [('string', p_brand), ('string', 'Brand#1')] ELSE [('string', 'Brand#1')] END),
                    unnest(CASE WHEN k % 6 = 2 THEN [1, 2] ELSE [1] END) FROM q
              UNION ALL SELECT k, 'size', unnest(CASE WHEN k % 2 = 0 THEN [('float', size || '.0'), ('string', 'x'), ('boolean', 'true')]
                    ELSE [('string', size::VARCHAR), ('boolean', 'true')] END), unnest(CASE WHEN k % 2 = 0 THEN [1, 2, 3] ELSE [1, 2] END) FROM q)
            SELECT profile, slug AS group_slug, n.field, col_no, row_no, x[1] AS kind, x[2] AS value
            FROM n JOIN v ON n.k = v.k AND n.field = v.field JOIN q ON q.k = n.k""",
        "group_summary_catalog": f"""WITH {q}, {wrong}, {broken}, {missing} SELECT slug AS group_slug, min(p_brand) AS group_name, min(type) AS dataset_type,
            count(DISTINCT np.k) AS datasets_with_non_standard_values, count(DISTINCT mr.k) AS datasets_with_missing_required_values,
            count(DISTINCT rx.k) AS datasets_with_invalid_input_patterns,
            count(DISTINCT coalesce(np.k, mr.k, rx.k)) AS total_datasets_with_issues
            FROM q LEFT JOIN np USING (k) LEFT JOIN mr USING (k) LEFT JOIN rx USING (k) GROUP BY slug""",
    }


def _value_lists(tables: str, rows: str, head: str) -> str:
    """Distinct values as fragments of JSON documents."""
    return f"""WITH {tables}, v AS ({rows}), n AS (SELECT *, count(*) OVER (PARTITION BY profile, field) AS c,
          row_number() OVER (PARTITION BY profile, field ORDER BY value) AS f,
          count(*) OVER (PARTITION BY profile) AS total, row_number() OVER (PARTITION BY profile ORDER BY field, value) AS ordinal FROM v)
        SELECT {head}ordinal, CASE ordinal WHEN 1 THEN '{{' ELSE ',' END || CASE f WHEN 1 THEN {_js('field')} || ':' ELSE '' END ||
          CASE WHEN f = 1 AND c > 1 THEN '[' ELSE '' END || {_js('value')} || CASE WHEN f = c AND c > 1 THEN ']' ELSE '' END ||
          CASE ordinal WHEN total THEN '}}' ELSE '' END AS text FROM n"""


def _broken_config() -> dict[str, str]:
    """Suppliers whose config files are broken, and the events of their profiles."""
    name = lambda kind: f"'{kind}/' || lpad(k::VARCHAR, 9, '0') || '.json'"
    found = f"""s AS (SELECT s_suppkey AS k, s_suppkey % 8 AS c FROM supplier), bad AS (
        SELECT k, 'rules' AS kind, {name('rules')} AS source_file, CASE c WHEN 0 THEN 'a rule file must be a JSON array'
            WHEN 1 THEN 'rule 2: __must__ must be an array of objects'
            ELSE 'rule 1 must be an object with ''when'' and ''then''' END AS problem FROM s WHERE c < 3
        UNION ALL SELECT k, 'field map', {name('field-map')},
            CASE c WHEN 3 THEN 'a field map must be a JSON object' ELSE 'invalid JSON' END FROM s WHERE c IN (3, 4)
        UNION ALL SELECT k, 'schema', {name('schema')}, 'a target schema must be a JSON array' FROM s WHERE c = 5
        UNION ALL SELECT NULL, 'value map', 'value-map/all.json', 'a value map must be a JSON object')"""
    damage = """CASE WHEN id % 10 IN (0, 6) THEN 'invalid JSON' WHEN id % 10 = 1 THEN 'input must contain a JSON object'
        WHEN id % 10 IN (2, 4) THEN 'metadata is not a JSON object' END"""
    told = f"""t AS (SELECT id, n, CASE WHEN id % 41 < 40 THEN id % 41 END AS p, {damage} AS damage FROM e),
        d AS (SELECT t.*, coalesce(damage, 'config: ' || own.kind || ' ' || own.source_file || ': ' || own.problem,
            CASE WHEN s.k IS NULL OR s.k % 3 = 0 THEN 'config: value map value-map/all.json: a value map must be a JSON object' END) AS error
          FROM t LEFT JOIN bad own ON own.k = p LEFT JOIN s ON s.k = p)"""
    return {
        "config_errors": f"WITH {found} SELECT kind, 's-' || k AS profile, source_file, problem FROM bad",
        "config_dead_letters": f"""WITH {EVENTS}, {found}, {told} SELECT 's-' || p AS profile,
            CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status, error, count(*) AS n FROM d GROUP BY p, error""",
        # The schema has "score" and "zone"; a damaged body that is still good has no "k".
        "config_survivors": f"""WITH {EVENTS}, {found}, {told}, g AS (SELECT id, p, n, id % 10 IN (3, 5) AS none FROM d WHERE error IS NULL)
            SELECT id, 's-' || p AS profile, 0 AS pos, 'score' AS field, CASE WHEN none THEN 'null' WHEN n = 1 THEN '"one"'
              WHEN n = 2 THEN '"two"' ELSE n::VARCHAR END AS value_json FROM g
            UNION ALL SELECT id, 's-' || p, 1, 'zone', CASE WHEN NOT none AND n = 1 THEN '"z' || p || '"' ELSE 'null' END FROM g""",
    }


def _nested() -> dict[str, str]:
    e = "e AS (SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 6 AS c, props FROM events)"
    return {
        "nested_diff": f"""WITH {e} SELECT id, 0 AS seq, 'replace' AS op, '/props/k' AS path, CAST(k + 1 AS VARCHAR) AS value_json FROM e WHERE c = 1
            UNION ALL SELECT id, 0, 'remove', '/tags/1', NULL FROM e WHERE c = 2
            UNION ALL SELECT id, 0, 'replace', '/tags/2', '"' || k || '"' FROM e WHERE c = 3
            UNION ALL SELECT id, 1, 'add', '/tags/0', '"new"' FROM e WHERE c = 3
            UNION ALL SELECT id, 0, 'replace', '/deep/v/1/w', CAST(k + 5 AS VARCHAR) FROM e WHERE c = 4
            UNION ALL SELECT id, 1, 'remove', '/deep/u', NULL FROM e WHERE c = 4
            UNION ALL SELECT id, 2, 'add', '/deep/q~0~1', 'null' FROM e WHERE c = 4
            UNION ALL SELECT id, 0, 'replace', '/tags', '{{"a":[]}}' FROM e WHERE c = 5
            UNION ALL SELECT id, 1, 'remove', '/n', NULL FROM e WHERE c = 5""",
        "nested_patch_applied": f"""WITH {e} SELECT id, '{{"props":{{"k":' || (k + CASE c WHEN 1 THEN 1 ELSE 0 END) || '}},"tags":' ||
              CASE c WHEN 2 THEN '["x",' || k || ',"z"]' WHEN 3 THEN '["new","x","y","' || k || '","z"]' WHEN 5 THEN '{{"a":[]}}'
                ELSE '["x","y",' || k || ',"z"]' END || ',"deep":' ||
              CASE c WHEN 4 THEN '{{"v":[{{"w":' || k || '}},{{"w":' || (k + 5) || '}}],"q~/":null}}' ELSE '{{"u":1,"v":[{{"w":' || k || '}},{{"w":0}}]}}' END ||
              CASE c WHEN 5 THEN '}}' ELSE ',"n":1.5}}' END AS body FROM e""",
    }
