"""DuckDB oracle SQL, one per registered query that SQL can express.

Written independently of the Spark plans where possible: globs as hand-written
regexes, as-of joins with DuckDB's ``ASOF JOIN``, quota with a plain ``lag``
over the whole key, line splitting with ``string_split``.
"""

from __future__ import annotations

from weir.plans.fixtures import SQL as FIXTURE_SQL

ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+0000')"

EXTRA = {
    "lines": """parts AS (SELECT path, string_split(text, chr(10)) AS p FROM files),
idx AS (SELECT path, p, unnest(generate_series(1, len(p))) AS i FROM parts),
lines0 AS (SELECT path, i - 1 AS line_no,
                  CASE WHEN i < len(p) THEN p[i] || chr(10) ELSE p[i] END AS message FROM idx),
lines AS (SELECT path, CAST(line_no AS BIGINT) AS line_no,
                 CAST(coalesce(sum(strlen(message)) OVER (PARTITION BY path ORDER BY line_no
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
                 CAST(strlen(message) AS BIGINT) AS nbytes, message
          FROM lines0 WHERE message <> '')""",
    "nfiles": """nfiles AS (SELECT CASE WHEN lang = 'en' THEN '/docs/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt'
                        ELSE '/docs/' || CAST(doc_id AS VARCHAR) || '.txt' END AS path, text,
                   len(string_split(text, chr(10)))
                     - CASE WHEN text = '' OR ends_with(text, chr(10)) THEN 1 ELSE 0 END AS n_lines
            FROM documents)""",
    "flagged": """flagged AS (
  SELECT seq, path, size, epoch_us(ts) AS us,
         lag(epoch_us(ts)) OVER (PARTITION BY path ORDER BY ts, seq) AS prev FROM writes)""",
    "status": """status AS (SELECT ts, arg_max(event_type IN ('signup', 'view', 'click'), event_id) AS ready FROM events GROUP BY ts)""",
    "entries": """pl AS (SELECT file, line_no, split_part(line, '=', 1) AS k0,
                   substr(line, strpos(line, '=') + 1) AS js FROM properties_lines WHERE strpos(line, '=') > 0),
pk AS (SELECT file, line_no,
              replace(replace(replace(replace(k0, 'monitoring_', ''), 'agent_', ''), 'logging_', ''), 'top_', '') AS key,
              CASE WHEN starts_with(ltrim(js), '{')
                   THEN flatten(list_transform(json_keys(js), lambda k: [k, json_extract_string(js, '$.' || k)]))
                   ELSE json_extract_string(js, '$[*]') END AS vals
       FROM pl WHERE starts_with(k0, 'monitoring_logging_') OR starts_with(k0, 'agent_')
                  OR k0 = 'monitoring_top_substitutions'),
entries AS (SELECT file, line_no, key, unnest(range(len(vals))) AS idx, unnest(vals) AS value FROM pk)""",
    "spellings": """spellings AS (
  SELECT event_id AS ord, '/var/log/' || event_type || '/u' || CAST(user_id AS VARCHAR) AS norm,
         CASE event_id % 4
           WHEN 0 THEN '/var/log/' || event_type || '/u' || CAST(user_id AS VARCHAR)
           WHEN 1 THEN '/var//log/./' || event_type || '/u' || CAST(user_id AS VARCHAR) || '/'
           WHEN 2 THEN '/var/log/' || event_type || '/../' || event_type || '/u' || CAST(user_id AS VARCHAR)
           ELSE 'var/log/' || event_type || '/u' || CAST(user_id AS VARCHAR) END AS dir
  FROM events)""",
    "enriched": """enriched AS (
  SELECT w.*, coalesce(u.name, '') AS "user", coalesce(g.name, '') AS "group",
         to_base64(encode(replace(coalesce(p.cmdline, ''), chr(0), ' '))) AS command
  FROM writes w LEFT JOIN users u USING (uid) LEFT JOIN groups g USING (gid) LEFT JOIN procs p USING (pid))""",
}


def sql(body: str, *names: str) -> str:
    parts = [FIXTURE_SQL[n] if n in FIXTURE_SQL else EXTRA[n] for n in names]
    sep = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return "WITH " + ",\n".join(parts) + sep + body


def _event_json(message: str, fields: str = "MAP {}::MAP(VARCHAR, VARCHAR)",
                tags: str = "[]::VARCHAR[]") -> str:
    return ("to_json({'path': '/var/log' || substr(path, 2), 'pid': pid, 'uid': uid, 'gid': gid, "
            f"'@message': {message}, '@timestamp': {ISO}, 'user': \"user\", 'group': \"group\", "
            f"'command': command, '@version': '0.1.6', '@fields': {fields}, '@tags': {tags}}})::VARCHAR")


STATIC_FIELDS_SQL = "MAP {'site': 'rack-7', 'note': 'two \"quoted\" words'}"
STATIC_TAGS_SQL = "['orders', 'a/b']"
ET = "regexp_extract(path, '^\\./([^/]+)/', 1)"
OVERFLOW = ("CASE WHEN prev IS NULL THEN false WHEN us - prev = 0 THEN true "
            "ELSE CAST(size AS DOUBLE) * 1000000.0 / CAST(us - prev AS DOUBLE) > 0.0001 END")
W = ("files", "lines")

ORACLE: dict[str, str] = {
    # ---------------------------------------------------------------- sources
    "split_lines": sql('SELECT path, line_no, "offset", nbytes, message FROM lines', *W),
    "tail_from_offsets": sql("""SELECT l.path, l.line_no, l."offset" + greatest(t.start - l."offset", 0) AS "offset",
       l.nbytes - greatest(t.start - l."offset", 0) AS nbytes
FROM lines l JOIN (SELECT f.path, CASE WHEN o."offset" IS NULL THEN 0 WHEN strlen(f.text) < o."offset" THEN 0
                                       ELSE o."offset" END AS start
                   FROM files f LEFT JOIN offsets o USING (path)) t USING (path)
WHERE l."offset" + l.nbytes > t.start""", "files", "offsets", "lines"),
    "utf8_repair": sql("""SELECT path, line_no,
       CASE WHEN cut = 0 THEN message
            ELSE repeat(chr(65533), CAST(strlen(lead) / 2 AS INTEGER)) || decode(unhex(substr(h, strlen(lead) + 1))) END
         AS message
FROM (SELECT l.path, l.line_no, l.message, greatest(t.start - l."offset", 0) AS cut,
             substr(hex(l.message), 2 * greatest(t.start - l."offset", 0) + 1) AS h,
             regexp_extract(substr(hex(l.message), 2 * greatest(t.start - l."offset", 0) + 1),
                            '^(([89AB][0-9A-F])*)', 1) AS lead
      FROM lines l JOIN (SELECT f.path, CASE WHEN o."offset" IS NULL THEN 0 WHEN strlen(f.text) < o."offset" THEN 0
                                             ELSE o."offset" END AS start
                         FROM files f LEFT JOIN offsets o USING (path)) t USING (path)
      WHERE l."offset" + l.nbytes > t.start)""", "files", "offsets", "lines"),
    "tail_latest": sql("""SELECT l.path, l.line_no, l."offset" + greatest(t.start - l."offset", 0) AS "offset",
       l.nbytes - greatest(t.start - l."offset", 0) AS nbytes
FROM lines l JOIN (SELECT f.path, CASE WHEN o."offset" IS NULL THEN strlen(f.text) WHEN strlen(f.text) < o."offset" THEN 0
                                       ELSE o."offset" END AS start
                   FROM files f LEFT JOIN offsets o USING (path)) t USING (path)
WHERE l."offset" + l.nbytes > t.start""", "files", "offsets", "lines"),
    "tail_earliest": sql("""SELECT path, line_no, "offset", nbytes FROM lines WHERE ends_with(message, chr(10))""", *W),
    "tail_new_offsets": sql("""SELECT f.path,
       greatest(strlen(f.text) - strlen(regexp_extract(f.text, '[^\\n]*$')),
                CASE WHEN o."offset" IS NULL THEN 0 WHEN strlen(f.text) < o."offset" THEN 0 ELSE o."offset" END) AS "offset"
FROM files f LEFT JOIN offsets o USING (path)""", "files", "offsets"),
    "tail_nonrecursive": sql("""SELECT '/docs' AS prefix, path, n_lines, strlen(text) AS bytes FROM nfiles
WHERE starts_with(path, '/docs/') AND strpos(substr(path, 7), '/') = 0 AND n_lines > 0""", "nfiles"),
    "tail_recursive": sql("""SELECT r.prefix, path, n_lines, strlen(text) AS bytes
FROM nfiles, (VALUES ('/docs'), ('/docs/src1')) r(prefix)
WHERE starts_with(path, r.prefix || '/') AND n_lines > 0""", "nfiles"),
    "multi_source_union": sql("""SELECT prefix, event_path, count(*) AS events, CAST(sum(nbytes) AS BIGINT) AS bytes FROM (
  SELECT prefix, prefix || substr(path, 2) AS event_path, size AS nbytes FROM writes
  UNION ALL SELECT '/', '/' || substr(path, 2), nbytes FROM lines) GROUP BY 1, 2""", "writes", *W),
    "write_events": """SELECT event_id AS seq, epoch_us(ts) AS ts_us, '/var/log' AS prefix,
       './' || event_type || '.log' AS path, hex(props || chr(0)) AS buf_hex,
       CAST(strlen(props) + 1 AS BIGINT) AS size, CAST(0 AS BIGINT) AS "offset", 0 AS pid,
       CAST(user_id AS INTEGER) AS uid, 0 AS gid FROM events""",
    "heartbeat": """WITH b AS (SELECT date_trunc('second', min(ts)) AS s, date_trunc('second', max(ts)) AS e FROM events),
t AS (SELECT unnest(generate_series(s, e, INTERVAL 1 SECOND)) AS ts FROM b)
SELECT strftime(ts, '%Y-%m-%d') AS day, '/example' AS path, 'ping' AS message, count(*) AS pings,
       min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM t GROUP BY 1""",
    "load_config": sql("SELECT file, line_no, key, idx, value FROM entries", "properties_lines", "entries"),
    "parse_args": sql("""toks AS (SELECT host_id, list_filter(string_split(line, ' '), lambda x: x <> '') AS t FROM argument_lines),
tk AS (SELECT host_id, unnest(t) AS tok, unnest(range(1, len(t) + 1)) AS pos FROM toks),
opt AS (SELECT *, length(tok) > 2 AND starts_with(tok, '--') AS is_opt FROM tk),
bad AS (SELECT DISTINCT host_id FROM opt WHERE is_opt AND substr(tok, 3) NOT IN
        ('directories', 'persist', 'excluded_files', 'substitutions', 'zookeepers', 'brokers', 'topic',
         'fields', 'tags', 'quota', 'input', 'output', 'encoder', 'debug', 'log')),
owned AS (SELECT host_id, tok, pos, is_opt,
                 max(CASE WHEN is_opt THEN pos END) OVER (PARTITION BY host_id ORDER BY pos
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM opt),
lastocc AS (SELECT host_id, tok, max(pos) AS lastpos FROM opt WHERE is_opt GROUP BY 1, 2),
vals AS (SELECT host_id, owner, string_agg(tok, ' ' ORDER BY pos) AS v, count(*) AS n
         FROM owned WHERE NOT is_opt AND owner IS NOT NULL GROUP BY 1, 2)
SELECT l.host_id, true AS ok, substr(l.tok, 3) AS key, CAST(coalesce(v.n, 0) AS INTEGER) AS n_values,
       coalesce(v.v, '') AS "values"
FROM lastocc l LEFT JOIN vals v ON v.host_id = l.host_id AND v.owner = l.lastpos
WHERE l.host_id NOT IN (SELECT host_id FROM bad)
UNION ALL SELECT host_id, false, NULL, NULL, NULL FROM bad""", "argument_lines"),
    # ---------------------------------------------------------------- sinks
    "route_topic": sql("""SELECT w.seq, coalesce(c.topic, 'logs') AS topic
FROM (SELECT seq, CASE WHEN seq % 97 <> 0 THEN ts END AS ts FROM writes) w
ASOF LEFT JOIN config_versions c ON w.ts >= c.effective_from""", "writes", "config_versions"),
    "render_report": sql(f"""SELECT seq, {ISO} || ' ' || '/var/log' || substr(path, 2) || ': ' || buf AS line
FROM writes""", "writes"),
    # ---------------------------------------------------------------- filters
    "exclude_paths": sql("""SELECT seq, path FROM writes
WHERE NOT starts_with(path, './error/') AND NOT regexp_matches(path, '^.*/u1.\\.log$')
  AND NOT regexp_matches(path, '^\\./[cv].*/u7\\.log$') AND NOT regexp_matches(path, '^\\./purchase/u[^0-4].*\\.log$')
  AND path <> './signup/u2.log'""", "writes"),
    "exclude_paths_table": sql("""SELECT seq, path FROM writes
WHERE path NOT IN (SELECT './view/u' || CAST(c_custkey AS VARCHAR) || '.log' FROM customer)
  AND NOT starts_with(path, './error/') AND NOT regexp_matches(path, '^.*/u1.\\.log$')
  AND NOT regexp_matches(path, '^\\./[cv].*/u7\\.log$')""", "writes"),
    "exclude_paths_index": sql("""SELECT seq, path FROM writes WHERE path NOT IN (
  SELECT './' || t || '/u' || CAST(c_custkey AS VARCHAR) || '.log' FROM customer, (SELECT DISTINCT event_type AS t FROM events)
  WHERE c_nationkey < 5 OR c_nationkey = 7)""", "writes"),
    "exclude_prefixes": sql("""SELECT ord AS seq, dir AS event_path FROM spellings
WHERE NOT starts_with(norm, '/var/log/view') AND NOT starts_with(norm, '/var/log/click/u1')""", "spellings"),
    "exclude_prefixes_table": sql("""p AS (SELECT '/var/log/click/u' || CAST(c_custkey AS VARCHAR) AS prefix FROM customer),
gone AS (SELECT DISTINCT norm FROM (SELECT DISTINCT norm FROM spellings) s WHERE EXISTS (
  SELECT 1 FROM p WHERE starts_with(s.norm, p.prefix)))
SELECT ord AS seq, dir AS event_path FROM spellings WHERE norm NOT IN (SELECT norm FROM gone)""", "spellings"),
    "sleep_mode": sql("""SELECT prefix, path FROM (
  SELECT prefix, path FROM writes
  UNION ALL SELECT '/srv/docs/' || source, './' || CAST(doc_id AS VARCHAR) || '.txt' FROM documents)
WHERE NOT starts_with(prefix, '/srv/docs/src1')""", "writes"),
    "encode_reject": """SELECT event_id AS seq, 'csv' AS encoder, 'unsupported encoder: csv' AS reason
FROM events WHERE event_type = 'signup'""",
    "between_markers": """WITH s AS (SELECT conv_id, min(turn) FILTER (WHERE role = 'assistant') AS fs,
                  min(turn) FILTER (WHERE role = 'system') AS fe FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.role FROM conversations c JOIN s USING (conv_id)
WHERE s.fs IS NOT NULL AND c.turn > s.fs AND (s.fe IS NULL OR c.turn < s.fe)
  AND c.role NOT IN ('assistant', 'system')""",
    # ---------------------------------------------------------------- quota, backlog
    "rate_limit": sql(f"SELECT seq, path FROM flagged WHERE NOT ({OVERFLOW})", "writes", "flagged"),
    "flag_overflow": sql(f"""SELECT seq, path, us - prev AS dt_us,
       CASE WHEN us - prev > 0 THEN CAST(size AS DOUBLE) * 1000000.0 / CAST(us - prev AS DOUBLE) END AS rate,
       {OVERFLOW} AS overflow FROM flagged""", "writes", "flagged"),
    "last_seen": sql("SELECT path, max(epoch_us(ts)) AS last_seen_us FROM writes GROUP BY path", "writes"),
    # Q3: the FIFO ring of 5 tracked paths of each shard, replayed row by row in (ts, seq) order.
    "rate_limit_bounded": sql(f"""rw AS (SELECT {ET} || '/' || CAST(uid % 8 AS VARCHAR) AS shard, seq, path, epoch_us(ts) AS us, size,
       row_number() OVER (PARTITION BY {ET} || '/' || CAST(uid % 8 AS VARCHAR) ORDER BY ts, seq) AS i FROM writes),
r AS (
  SELECT DISTINCT shard, 0::BIGINT AS i, NULL::BIGINT AS seq, NULL::BOOLEAN AS overflow,
         list_transform(range(5), lambda x: NULL::VARCHAR) AS ks,
         list_transform(range(5), lambda x: 0::BIGINT) AS ls, 0 AS ptr FROM rw
  UNION ALL
  SELECT w.shard, w.i, w.seq,
         CASE WHEN list_position(r.ks, w.path) IS NULL THEN false
              WHEN w.us - r.ls[list_position(r.ks, w.path)] = 0 THEN true
              ELSE CAST(w.size AS DOUBLE) * 1000000.0 / CAST(w.us - r.ls[list_position(r.ks, w.path)] AS DOUBLE) > 0.0001 END,
         CASE WHEN list_position(r.ks, w.path) IS NULL
              THEN list_transform(r.ks, lambda k, j: CASE WHEN j = (r.ptr + 1) % 5 + 1 THEN w.path ELSE k END)
              ELSE r.ks END,
         list_transform(r.ls, lambda v, j: CASE WHEN j = coalesce(list_position(r.ks, w.path), (r.ptr + 1) % 5 + 1)
                                                 THEN w.us ELSE v END),
         CASE WHEN list_position(r.ks, w.path) IS NULL THEN (r.ptr + 1) % 5 ELSE r.ptr END
  FROM r JOIN rw w ON w.shard = r.shard AND w.i = r.i + 1)
SELECT seq, path, overflow FROM r JOIN rw USING (seq, i) WHERE i > 0""", "writes").replace("WITH writes", "WITH RECURSIVE writes", 1),
    "bounded_backlog": sql("SELECT seq, path FROM writes ORDER BY ts DESC, seq DESC LIMIT 1000", "writes"),
    "bounded_backlog_sharded": sql(f"""SELECT seq, event_type FROM (
  SELECT seq, {ET} AS event_type,
         row_number() OVER (PARTITION BY {ET} ORDER BY ts DESC, seq DESC) AS rn FROM writes) WHERE rn <= 50""",
                                   "writes"),
    "bounded_backlog_default": sql(f"""SELECT seq, event_type FROM (
  SELECT seq, {ET} AS event_type,
         row_number() OVER (PARTITION BY {ET} ORDER BY ts DESC, seq DESC) AS rn FROM writes) WHERE rn <= 10000""",
                                   "writes"),
    "drain_backlog": sql(f"""b AS (SELECT * FROM writes WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
           ORDER BY ts DESC, seq DESC LIMIT 1000),
u AS (SELECT * FROM b UNION ALL SELECT * FROM writes WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'),
x AS (SELECT seq, path, size, epoch_us(ts) AS us,
             lag(epoch_us(ts)) OVER (PARTITION BY path ORDER BY ts, seq) AS prev
      FROM u WHERE NOT starts_with(path, './error/'))
SELECT seq, path FROM x WHERE NOT ({OVERFLOW})""", "writes"),
    "route_ready": sql("""SELECT w.seq, CASE WHEN coalesce(s.ready, false) THEN 'sink' ELSE 'backlog' END AS route
FROM (SELECT seq, CASE WHEN seq % 97 <> 0 THEN ts END AS ts FROM writes) w ASOF LEFT JOIN status s ON w.ts >= s.ts""",
                       "writes", "status"),
    # ---------------------------------------------------------------- enrichment
    "with_user": sql("""SELECT w.seq, w.uid, coalesce(u.name, '') AS "user" FROM writes w LEFT JOIN users u USING (uid)""",
                     "writes", "users"),
    "with_group": sql("""SELECT w.seq, w.gid, coalesce(g.name, '') AS "group" FROM writes w LEFT JOIN groups g USING (gid)""",
                      "writes", "groups"),
    "with_command": sql("""SELECT w.seq, w.pid, to_base64(encode(replace(coalesce(p.cmdline, ''), chr(0), ' '))) AS command
FROM writes w LEFT JOIN procs p USING (pid)""", "writes", "procs"),
    "with_static": sql(f"""SELECT seq, to_json({STATIC_FIELDS_SQL})::VARCHAR AS fields_json,
       to_json({STATIC_TAGS_SQL})::VARCHAR AS tags_json FROM writes""", "writes"),
    "with_config": sql("""SELECT w.seq, c.topic, c.site, c.tag
FROM (SELECT seq, CASE WHEN seq % 97 <> 0 THEN ts END AS ts FROM writes) w
ASOF LEFT JOIN config_versions c ON w.ts >= c.effective_from""", "writes", "config_versions"),
    "with_config_history": """WITH h AS (SELECT o_orderdate AS since, max(o_orderkey) AS n, arg_max(o_orderstatus, o_orderkey) AS state
  FROM orders GROUP BY o_orderdate),
w AS (SELECT l_orderkey * 8 + l_linenumber AS seq, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_linenumber) AS ts FROM lineitem)
SELECT w.seq, h.n, h.state FROM w ASOF LEFT JOIN h ON w.ts >= CAST(h.since AS TIMESTAMP)""",
    "stream_with_config": sql("""SELECT w.seq, h.state FROM writes w ASOF LEFT JOIN (
  SELECT ts AS since, 'sink-' || CAST(max(event_id) % 5 AS VARCHAR) AS state FROM events WHERE event_type = 'purchase' GROUP BY ts) h
ON w.ts >= h.since""", "writes"),
    # ---------------------------------------------------------------- encode / decode
    "encode_b64": sql("SELECT seq, " + _event_json("to_base64(encode(buf))", STATIC_FIELDS_SQL, STATIC_TAGS_SQL)
                      + " AS value FROM enriched", "writes", "users", "groups", "procs", "enriched"),
    "encode_json": sql("SELECT seq, " + _event_json("buf", STATIC_FIELDS_SQL, STATIC_TAGS_SQL)
                       + " AS value FROM enriched", "writes", "users", "groups", "procs", "enriched"),
    "encode_text": sql(f"SELECT seq, {ISO} || ': ' || path || ': ' || buf AS value FROM writes", "writes"),
    "obfuscate": sql("SELECT seq, translate(hex(" + _event_json("buf", STATIC_FIELDS_SQL, STATIC_TAGS_SQL)
                     + "), '0123456789ABCDEF', 'FEDCBA9876543210') AS value_hex FROM enriched",
                     "writes", "users", "groups", "procs", "enriched"),
    "nul_cut": f"""SELECT event_id AS seq, 'text' AS encoder, {ISO} || ': ./nul.log: ' || event_type AS value FROM events
UNION ALL SELECT seq, 'logstash', {_event_json('buf')} FROM (
  SELECT event_id AS seq, ts, './nul.log' AS path, 0 AS pid, 0 AS uid, 0 AS gid, '' AS "user", '' AS "group", '' AS command,
         event_type AS buf FROM events)""",
    "deobfuscate": sql(f"""SELECT seq, CASE {ET} WHEN 'click' THEN hex({_event_json('buf')})
       WHEN 'error' THEN translate(hex({ISO} || ': ' || path || ': ' || buf), '0123456789ABCDEF', 'FEDCBA9876543210')
       ELSE hex({_event_json('to_base64(encode(buf))')}) END AS value_hex
FROM enriched WHERE {ET} <> 'signup'""", "writes", "users", "groups", "procs", "enriched"),
    "decode_events": sql("""SELECT seq, '/var/log' || substr(path, 2) AS path, uid, buf AS "@message", "user", "group",
       replace(coalesce(p.cmdline, ''), chr(0), ' ') AS command, '0.1.6' AS "@version",
       CAST(strlen(buf) AS INTEGER) AS "message_size-added"
FROM (SELECT w.*, coalesce(u.name, '') AS "user", coalesce(g.name, '') AS "group"
      FROM writes w LEFT JOIN users u USING (uid) LEFT JOIN groups g USING (gid)) LEFT JOIN procs p USING (pid)""",
                         "writes", "users", "groups", "procs"),
    "dead_letters": "SELECT event_id AS seq, 'not a JSON event' AS reason FROM events WHERE event_type = 'error'",
    "decode_versioned": sql(f"""SELECT seq,
       CASE {ET} WHEN 'view' THEN '0.1.1' WHEN 'click' THEN '0.1.2' WHEN 'error' THEN '0.2'
                 WHEN 'purchase' THEN 'x.1' ELSE '0.1.6' END AS "@version",
       CASE WHEN {ET} IN ('view', 'purchase') THEN to_base64(encode(buf)) ELSE buf END AS "@message",
       CASE WHEN {ET} IN ('view', 'purchase') THEN command
            ELSE replace(coalesce(cmdline, ''), chr(0), ' ') END AS command
FROM (SELECT e.*, p.cmdline FROM enriched e LEFT JOIN procs p USING (pid))""",
                            "writes", "users", "groups", "procs", "enriched"),
    "message_size": sql("""SELECT seq, CAST(strlen(buf) AS INTEGER) AS "message_size-added" FROM writes""", "writes"),
    "select_fields": sql("""SELECT '/var/log' || substr(path, 2) AS path, buf AS "@message", uid FROM writes""", "writes"),
    "render_event": sql(f"""SELECT seq, 'event:' || chr(10) ||
  '  path: /var/log' || substr(path, 2) || chr(10) ||
  '  pid: ' || pid || chr(10) || '  uid: ' || uid || chr(10) || '  gid: ' || gid || chr(10) ||
  '  @message: ' || buf || chr(10) || '  @timestamp: ' || {ISO} || chr(10) ||
  '  user: ' || "user" || chr(10) || '  group: ' || "group" || chr(10) ||
  '  command: ' || replace(coalesce(p.cmdline, ''), chr(0), ' ') || chr(10) ||
  '  @version: 0.1.6' || chr(10) ||
  '  @fields: ' || chr(10) || '     site: rack-7' || chr(10) || '     note: two "quoted" words' || chr(10) ||
  '  @tags: ' || chr(10) || '    -  orders' || chr(10) || '    -  a/b' AS text
FROM (SELECT w.*, coalesce(u.name, '') AS "user", coalesce(g.name, '') AS "group"
      FROM writes w LEFT JOIN users u USING (uid) LEFT JOIN groups g USING (gid)) LEFT JOIN procs p USING (pid)""",
                        "writes", "users", "groups", "procs"),
    # ---------------------------------------------------------------- aggregates, sets
    "decode_minimal": """SELECT event_id AS seq, event_type AS command, props AS "@message",
       CAST(strlen(props) AS INTEGER) AS "message_size-added", CAST(NULL AS VARCHAR) AS path, event_type AS kind FROM events""",
    "decode_broken": """SELECT event_id AS seq, CASE event_id % 6 WHEN 2 THEN 'a key of another type' ELSE 'not a JSON event' END AS reason
FROM events WHERE event_id % 6 < 4""",
    "merge_config": sql("""SELECT key, row_number() OVER (PARTITION BY key ORDER BY file, line_no, idx) - 1 AS pos, value
FROM entries""", "properties_lines", "entries"),
    "missing_ranges": """WITH r AS (SELECT DISTINCT event_id AS id FROM events WHERE value > 5),
n AS (SELECT count(*) AS n FROM events),
m AS (SELECT g.id FROM n, range(n.n) g(id) WHERE g.id NOT IN (SELECT id FROM r)),
k AS (SELECT id, id - row_number() OVER (ORDER BY id) AS grp FROM m)
SELECT min(id) AS first, max(id) AS last FROM k GROUP BY grp""",
    "explode_numbers": sql("""SELECT seq, pos, item,
       coalesce(TRY_CAST(regexp_extract(item, '^\\s*([+-]?[0-9]+)', 1) AS BIGINT), 0) AS number
FROM (SELECT seq, unnest(l) AS item, unnest(range(len(l))) AS pos
      FROM (SELECT seq, list_filter(regexp_split_to_array(trim(buf), '\\s+'), lambda x: x <> '') AS l FROM writes))""",
                           "writes"),
    "delivery_summary": sql("""SELECT count(*) AS events, max(epoch_us(ts)) - min(epoch_us(ts)) AS duration_us FROM writes""",
                            "writes"),
    "compare_captures": sql(f"""a AS (SELECT path, buf AS message FROM writes),
b AS (SELECT f.path, w.buf AS message FROM flagged f JOIN (SELECT seq, buf FROM writes) w USING (seq) WHERE NOT ({OVERFLOW})),
na AS (SELECT path, count(*) AS n_a FROM a GROUP BY 1),
nb AS (SELECT path, count(*) AS n_b FROM b GROUP BY 1),
oa AS (SELECT path, count(*) AS only_a FROM (SELECT path, message FROM a EXCEPT ALL SELECT path, message FROM b) GROUP BY 1),
ob AS (SELECT path, count(*) AS only_b FROM (SELECT path, message FROM b EXCEPT ALL SELECT path, message FROM a) GROUP BY 1)
SELECT path, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, coalesce(only_a, 0) AS only_a,
       coalesce(only_b, 0) AS only_b
FROM na FULL JOIN nb USING (path) LEFT JOIN oa USING (path) LEFT JOIN ob USING (path)""", "writes", "flagged"),
    "volume_by_path": sql("""SELECT '/var/log' || substr(path, 2) AS path, count(*) AS events,
       CAST(sum(strlen(buf)) AS BIGINT) AS bytes FROM writes GROUP BY 1""", "writes"),
    "unique_paths": sql("SELECT arg_min(dir, ord) AS dir, min(ord) AS ord, norm AS normalized FROM spellings GROUP BY norm",
                        "spellings"),
    "merge_servers": """SELECT s_suppkey,
       CASE s_suppkey % 4 WHEN 0 THEN lower(n_name) || ':9092,' WHEN 1 THEN lower(n_name) || ':9092'
            ELSE lower(n_name) || ':9092,' || lower(s_name) || ':9092' END AS merged,
       s_suppkey % 4 <> 1 AS any_new
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "watch_diff": sql("""conf AS (SELECT DISTINCT norm AS dir FROM spellings UNION SELECT '/srv/new'),
wat AS (SELECT DISTINCT '/var/log/' || event_type AS dir FROM events WHERE event_type IN ('click', 'error')
        UNION SELECT '/var/log/old' UNION SELECT '/var/log/view/u1')
SELECT 'start' AS action, dir FROM conf c WHERE NOT EXISTS (SELECT 1 FROM wat w WHERE starts_with(c.dir, w.dir))
UNION ALL SELECT 'stop', dir FROM wat WHERE dir NOT IN (SELECT dir FROM conf)""", "spellings"),
    # ---------------------------------------------------------------- scalar functions
    "djb2": sql("""SELECT seq, path, CAST(list_reduce(list_transform(range(strlen(path)), lambda i: ascii(substr(path, i + 1, 1))),
       lambda acc, c: (acc * 33 + c) % CAST('18446744073709551616' AS HUGEINT), CAST(5381 AS HUGEINT)) AS VARCHAR) AS djb2
FROM writes""", "writes"),
    "iso_timestamp": sql(f"SELECT seq, {ISO} AS ts_iso FROM writes", "writes"),
    "path_join": """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN lower(c_mktsegment) END || '/' || c_name AS joined
FROM customer""",
    "pairs_to_map": sql("""e AS (SELECT * FROM entries WHERE key = 'fields'),
kv AS (SELECT a.file, a.line_no, a.idx, a.value AS k, b.value AS v
       FROM e a JOIN e b ON a.file = b.file AND a.line_no = b.line_no AND b.idx = a.idx + 1 WHERE a.idx % 2 = 0)
SELECT file, line_no, k, arg_max(v, idx) AS v FROM kv GROUP BY file, line_no, k""", "properties_lines", "entries"),
    "get_property": sql("""SELECT file, arg_min(regexp_replace(substr(line, strpos(line, '=') + 1), '^\\s+|\\s+$', '', 'g'), line_no) AS value
FROM properties_lines WHERE split_part(line, '=', 1) = 'agent_quota' AND strpos(line, '=') > 0
GROUP BY file""", "properties_lines"),
}

# The streams give what their batch twins give; a shard in segments, what it gives as a whole.
ORACLE["rate_limit_bounded_segments"] = ORACLE["rate_limit_bounded"].replace(f"{ET} || '/' || CAST(uid % 8 AS VARCHAR)", ET)
ORACLE["stream_rate_limit"] = ORACLE["rate_limit"]
ORACLE["stream_rate_limit_bounded"] = ORACLE["rate_limit_bounded"]
ORACLE["stream_backlog"] = ORACLE["drain_backlog"]
ORACLE["stream_missing_ranges"] = ORACLE["missing_ranges"]


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
