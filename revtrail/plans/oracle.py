"""DuckDB SQL oracles, one per registered query.

They are written independently of the Spark plans: trees are recomputed
by brute force (state of every path at every revision), revision chains
by a recursive CTE, as-of lookups with ASOF JOIN or correlated maxima.
"""

from __future__ import annotations

from revtrail.sources.adapters import DUMP_QUOTA

EMPTY = "'4b825dc642cb6eb9a060e54bf8d69288fbee4904'"


def git_sha(kind: str, body_hex: str) -> str:
    """SQL for the git object id of a body given as a hex string."""
    return (f"sha1(unhex(hex('{kind} ' || CAST(length({body_hex}) // 2 AS VARCHAR)) "
            f"|| '00' || {body_hex}))")


STAMP = ("CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN CAST(epoch_us({ts}) // 1000000 AS VARCHAR) "
         "ELSE CAST(epoch_us({ts}) // 1000000 AS VARCHAR) || '.' || "
         "rtrim(lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0'), '0') END")

UUID = ("substr(md5({o}),1,8) || '-' || substr(md5({o}),9,4) || '-' || substr(md5({o}),13,4) "
        "|| '-' || substr(md5({o}),17,4) || '-' || substr(md5({o}),21,12)")

# adapter E as plain SQL, then brute-force state at every revision
E_BASE = f"""
ev AS (
  SELECT 'u' || user_id AS origin, event_id, ts, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rev
  FROM events),
ch AS (
  SELECT origin, rev, event_id, event_type, ts,
         'd' || CAST(k // 10 AS VARCHAR) AS dname, 'f' || CAST(k AS VARCHAR) AS fname,
         CASE WHEN event_type = 'error' THEN 'delfile'
              WHEN event_type = 'signup' AND k % 10 = 0 THEN 'deldir' ELSE 'put' END AS op,
         event_type || ' ' || CAST(event_id AS VARCHAR) AS data
  FROM ev),
revs AS (SELECT origin, rev FROM ev),
fe AS (SELECT origin, dname, fname, rev, op,
              {git_sha('blob', 'hex(data)')} AS blob_id
       FROM ch WHERE op IN ('put', 'delfile')),
dd AS (SELECT origin, dname, rev FROM ch WHERE op = 'deldir'),
fst AS (
  SELECT r.origin, r.rev AS at_rev, fe.dname, fe.fname,
         arg_max(fe.op, fe.rev) AS op, arg_max(fe.blob_id, fe.rev) AS blob_id,
         max(fe.rev) AS put_rev
  FROM revs r JOIN fe ON fe.origin = r.origin AND fe.rev <= r.rev
  GROUP BY r.origin, r.rev, fe.dname, fe.fname),
falive AS (
  SELECT * FROM fst WHERE op = 'put' AND NOT EXISTS (
    SELECT 1 FROM dd WHERE dd.origin = fst.origin AND dd.dname = fst.dname
      AND dd.rev > fst.put_rev AND dd.rev <= fst.at_rev)),
dev AS (SELECT origin, dname, rev, op = 'put' AS is_put FROM ch WHERE op IN ('put', 'deldir')),
dalive AS (
  SELECT r.origin, r.rev AS at_rev, dev.dname
  FROM revs r JOIN dev ON dev.origin = r.origin AND dev.rev <= r.rev
  GROUP BY r.origin, r.rev, dev.dname
  HAVING arg_max(dev.is_put, dev.rev)),
dtree AS (
  SELECT d.origin, d.at_rev, d.dname,
         coalesce(string_agg(hex('100644 ' || f.fname) || '00' || f.blob_id, ''
                             ORDER BY f.fname), '') AS body
  FROM dalive d LEFT JOIN falive f
    ON f.origin = d.origin AND f.at_rev = d.at_rev AND f.dname = d.dname
  GROUP BY d.origin, d.at_rev, d.dname),
dtid AS (SELECT origin, at_rev, dname, {git_sha('tree', 'body')} AS tree_id FROM dtree),
rtree AS (
  SELECT r.origin, r.rev,
         coalesce(string_agg(hex('40000 ' || t.dname) || '00' || t.tree_id, ''
                             ORDER BY t.dname || '/'), '') AS body
  FROM revs r LEFT JOIN dtid t ON t.origin = r.origin AND t.at_rev = r.rev
  GROUP BY r.origin, r.rev),
rtid AS (SELECT origin, rev, {git_sha('tree', 'body')} AS tree_id FROM rtree),
meta AS (
  SELECT t.origin, t.rev, t.tree_id,
         ev.event_type || ' ' || {STAMP.format(ts='ev.ts')} || ' +0000' AS who,
         'svn_repo_uuid ' || {UUID.format(o='t.origin')} || chr(10) || 'svn_revision '
           || CAST(t.rev AS VARCHAR) || chr(10) || chr(10) || 'event '
           || CAST(ev.event_id AS VARCHAR) AS tail
  FROM rtid t JOIN ev ON ev.origin = t.origin AND ev.rev = t.rev),
chain AS (
  SELECT * FROM (
    WITH RECURSIVE c(origin, rev, revision_id) AS (
      SELECT origin, rev, {git_sha('commit', "hex('tree ' || tree_id || chr(10) || 'author ' || who || chr(10) || 'committer ' || who || chr(10) || tail)")}
      FROM meta WHERE rev = 1
      UNION ALL
      SELECT m.origin, m.rev, {git_sha('commit', "hex('tree ' || m.tree_id || chr(10) || 'parent ' || c.revision_id || chr(10) || 'author ' || m.who || chr(10) || 'committer ' || m.who || chr(10) || m.tail)")}
      FROM meta m JOIN c ON m.origin = c.origin AND m.rev = c.rev + 1)
    SELECT * FROM c))
"""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["build_snapshot"] = f"""
WITH {E_BASE},
head AS (SELECT origin, max(rev) AS head_rev FROM revs GROUP BY origin)
SELECT h.origin, h.head_rev, t.tree_id, c.revision_id,
       {git_sha('snapshot', "hex('revision HEAD') || '00' || hex('20:') || c.revision_id")} AS snapshot_id
FROM head h JOIN rtid t ON t.origin = h.origin AND t.rev = h.head_rev
JOIN chain c ON c.origin = h.origin AND c.rev = h.head_rev
"""

ORACLE_SQL["tree_ids"] = f"WITH {E_BASE} SELECT origin, rev, tree_id FROM rtid"

ORACLE_SQL["revision_chain"] = f"WITH {E_BASE} SELECT origin, rev, revision_id FROM chain"

# versions by the direct rule: end = next own event or the first later
# delete of the directory, whichever comes first
E_VERSIONS = f"""
{E_BASE},
fv AS (
  SELECT origin, dname, fname, rev AS from_rev, op, blob_id,
         lead(rev) OVER (PARTITION BY origin, dname, fname ORDER BY rev) AS next_rev
  FROM fe),
fv2 AS (
  SELECT fv.*, (SELECT min(dd.rev) FROM dd WHERE dd.origin = fv.origin AND dd.dname = fv.dname
                AND dd.rev > fv.from_rev) AS dir_del
  FROM fv WHERE op = 'put')
"""

ORACLE_SQL["replay_state"] = f"""
WITH {E_VERSIONS}
SELECT origin, dname || '/' || fname AS path, blob_id, from_rev,
       CASE WHEN next_rev IS NULL THEN dir_del WHEN dir_del IS NULL THEN next_rev
            ELSE least(next_rev, dir_del) END AS to_rev
FROM fv2
"""

ORACLE_SQL["delete_cascade"] = f"""
WITH {E_VERSIONS}
SELECT origin, dname || '/' || fname AS path, from_rev, dir_del AS to_rev
FROM fv2 WHERE dir_del IS NOT NULL AND (next_rev IS NULL OR dir_del < next_rev)
"""

ORACLE_SQL["head_revision"] = f"""
WITH {E_BASE}
SELECT origin, dname AS path, max(at_rev) AS head_rev FROM dalive GROUP BY origin, dname
"""

ORACLE_SQL["object_stats"] = f"""
WITH {E_BASE}
SELECT 'content' AS object_type, count(DISTINCT blob_id) AS n FROM fe WHERE op = 'put'
UNION ALL
SELECT 'directory', count(DISTINCT id) FROM (
  SELECT tree_id AS id FROM dtid UNION SELECT tree_id FROM rtid UNION SELECT {EMPTY})
UNION ALL SELECT 'revision', count(DISTINCT revision_id) FROM chain
UNION ALL SELECT 'snapshot', count(DISTINCT origin) FROM revs
UNION ALL SELECT 'origin', count(DISTINCT origin) FROM revs
"""

ORACLE_SQL["rev_at_date"] = f"""
WITH {E_BASE},
days AS (SELECT DISTINCT origin, CAST(ts AS DATE) AS day FROM ev
         UNION SELECT origin, CAST(min(ts) AS DATE) - 1 FROM ev GROUP BY origin),
p AS (SELECT origin, day, CAST(day AS TIMESTAMP) + INTERVAL 12 HOUR AS probe FROM days)
SELECT p.origin, CAST(p.day AS VARCHAR) AS day,
       (SELECT max(rev) FROM ev WHERE ev.origin = p.origin AND ev.ts <= p.probe) AS rev
FROM p
"""

ORACLE_SQL["conv_revision_chain"] = f"""
WITH meta AS (
  SELECT 'v' || CAST(conv_id AS VARCHAR) AS origin, turn + 1 AS rev, {EMPTY} AS tree_id,
         role || ' 0 +0000' AS who,
         'svn_repo_uuid ' || {UUID.format(o="('v' || CAST(conv_id AS VARCHAR))")} || chr(10)
           || 'svn_revision ' || CAST(turn + 1 AS VARCHAR) || chr(10) || chr(10) || text AS tail
  FROM conversations),
chain AS (
  SELECT * FROM (
    WITH RECURSIVE c(origin, rev, revision_id) AS (
      SELECT origin, rev, {git_sha('commit', "hex('tree ' || tree_id || chr(10) || 'author ' || who || chr(10) || 'committer ' || who || chr(10) || tail)")}
      FROM meta WHERE rev = 1
      UNION ALL
      SELECT m.origin, m.rev, {git_sha('commit', "hex('tree ' || m.tree_id || chr(10) || 'parent ' || c.revision_id || chr(10) || 'author ' || m.who || chr(10) || 'committer ' || m.who || chr(10) || m.tail)")}
      FROM meta m JOIN c ON m.origin = c.origin AND m.rev = c.rev + 1)
    SELECT * FROM c))
SELECT origin, rev, {EMPTY} AS tree_id, revision_id FROM chain
"""

ORACLE_SQL["check_sample"] = """
WITH c AS (SELECT 'v' || CAST(conv_id AS VARCHAR) AS origin, turn + 1 AS rev FROM conversations),
o AS (SELECT origin, rev, row_number() OVER (PARTITION BY origin ORDER BY rev) AS ordinal,
             max(rev) OVER (PARTITION BY origin) AS last_rev FROM c)
SELECT origin, rev, ordinal, (rev >= 2 AND ordinal % 3 = 0) OR rev = last_rev AS verify FROM o
"""

ORACLE_SQL["parse_person"] = """
WITH f AS (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN ''
                         WHEN c_custkey % 2 = 0 THEN c_name || ' <' || lower(c_mktsegment) || '@example.org>'
                         ELSE c_name END AS fullname
  FROM customer)
SELECT c_custkey, fullname,
       nullif(trim(CASE WHEN strpos(fullname, '<') > 0 THEN split_part(fullname, '<', 1) ELSE fullname END), '') AS name,
       CASE WHEN strpos(fullname, '<') > 0 THEN nullif(regexp_extract(fullname, '<(.*)>', 1), '') END AS email
FROM f
"""

ORACLE_SQL["svn_date"] = """
SELECT event_id,
       CASE WHEN event_id % 5 = 0 THEN 0 ELSE epoch_us(ts) // 1000000 END AS seconds,
       CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE epoch_us(ts) % 1000000 END AS INTEGER) AS micros,
       '+0000' AS "offset"
FROM events
"""

ORACLE_SQL["content_ids"] = f"""
SELECT doc_id, sha1(text) AS sha1, {git_sha('blob', 'hex(text)')} AS sha1_git,
       sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS length
FROM documents
"""

ORACLE_SQL["size_split"] = f"""
SELECT doc_id, CASE WHEN strlen(text) > 100000 THEN 'skipped' ELSE 'content' END AS status,
       {git_sha('blob', 'hex(text)')} AS sha1_git
FROM documents
"""

ORACLE_SQL["anti_archive"] = f"""
SELECT DISTINCT {git_sha('blob', 'hex(d.text)')} AS id FROM documents d
EXCEPT
SELECT {git_sha('blob', 'hex(d.text)')} FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels)
"""

ORACLE_SQL["apply_eol"] = f"""
WITH s AS (SELECT doc_id, text, ['native', 'LF', 'CRLF', 'CR', 'bogus'][doc_id % 5 + 1] AS eol FROM documents),
c AS (SELECT doc_id, eol, CASE eol
        WHEN 'native' THEN regexp_replace(text, '\\r\\n|\\r|\\n', chr(10), 'g')
        WHEN 'LF' THEN regexp_replace(text, '\\r\\n|\\r|\\n', chr(10), 'g')
        WHEN 'CRLF' THEN regexp_replace(text, '\\r\\n|\\r|\\n', chr(13) || chr(10), 'g')
        WHEN 'CR' THEN regexp_replace(text, '\\r\\n|\\r|\\n', chr(13), 'g')
        ELSE text END AS data FROM s)
SELECT doc_id, eol, {git_sha('blob', 'hex(data)')} AS sha1_git FROM c
"""

ORACLE_SQL["static_tree"] = f"""
WITH f AS (
  SELECT r.r_name, n.n_name, {git_sha('blob', 'hex(n.n_name)')} AS blob_id
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
d AS (SELECT r_name, string_agg(hex('100644 ' || n_name) || '00' || blob_id, '' ORDER BY n_name) AS body
      FROM f GROUP BY r_name),
dt AS (SELECT r_name AS path, {git_sha('tree', 'body')} AS tree_id FROM d),
rt AS (SELECT '' AS path, {git_sha('tree', "string_agg(hex('40000 ' || path) || '00' || tree_id, '' ORDER BY path || '/')")} AS tree_id FROM dt)
SELECT path, tree_id FROM dt UNION ALL SELECT path, tree_id FROM rt
"""

_SAFE_HEX = "'" + "','".join(sorted({format(ord(c), "02X") for c in
                                       "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-~/:!$&'()*+,=@"})).replace("'27'", "'27'") + "'"


def _quote_sql(expr: str) -> str:
    h = f"upper(hex({expr}))"
    return (f"array_to_string(list_transform(range(0, strlen({expr})), lambda i: CASE WHEN "
            f"substr({h}, 2*i+1, 2) IN ({_SAFE_HEX}) THEN chr(CAST(('0x' || substr({h}, 2*i+1, 2)) AS INTEGER)) "
            f"ELSE '%' || substr({h}, 2*i+1, 2) END), '')")


ORACLE_SQL["url_quote"] = f"""
WITH r AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url || '/a b%c/é~x' ELSE url END AS raw FROM pages)
SELECT page_id, {_quote_sql('raw')} AS quoted, raw AS roundtrip FROM r
"""

ORACLE_SQL["url_join"] = """
WITH b AS (
  SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS netloc,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
j AS (SELECT page_id, scheme, netloc,
             rtrim(CASE WHEN path = '' THEN '/' ELSE path END, '/') || '/trunk/../lib' || CAST(page_id % 10 AS VARCHAR) AS joined
      FROM b)
SELECT page_id, scheme || '://' || netloc || '/' || array_to_string(list_reduce(string_split(joined, '/'),
  lambda acc, x: CASE WHEN x IN ('', '.') THEN acc WHEN x = '..' THEN acc[1:len(acc)-1] ELSE list_append(acc, x) END,
  []::VARCHAR[]), '/') AS joined
FROM j
"""

ORACLE_SQL["root_url_candidates"] = """
WITH s AS (SELECT page_id, string_split(url, '/') AS parts FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS pos, array_to_string(parts[1:len(parts) - i], '/') AS candidate
FROM s, range(0, len(parts)) t(i)
"""

ORACLE_SQL["strip_credentials"] = """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'user' || CAST(page_id AS VARCHAR) END AS username, url
FROM pages
"""

ORACLE_SQL["dump_name"] = """
SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}]', '', 'g') AS dump_name FROM pages
"""

ORACLE_SQL["ancestors"] = """
WITH s AS (SELECT page_id, string_split(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g'), '/') AS parts FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, array_to_string(parts[1:i], '/') AS prefix
FROM s, range(1, len(parts) + 1) t(i)
WHERE NOT (len(parts) = 1 AND parts[1] = '')
"""

ORACLE_SQL["parse_external"] = """
WITH p AS (SELECT page_id, url, 'lib' || CAST(page_id AS VARCHAR) AS name,
                  page_id % 50 + 1 AS n, page_id % 6 AS form FROM pages)
SELECT page_id,
       CASE WHEN form = 5 THEN 'sub/' || name ELSE name END AS path,
       CASE WHEN form IN (0, 1, 2, 3) THEN url
            WHEN form = 4 AND page_id % 12 = 4 THEN 'http://s.example/r/main/trunk'
            WHEN form = 4 THEN 'http://s.example/r/main/vendor/' || name
            ELSE 'http://s.example/r/main/trunk/' || name END AS url,
       CASE WHEN form = 2 THEN CAST(n AS BIGINT) END AS revision,
       CASE WHEN form = 3 THEN CAST(n AS BIGINT) END AS peg_revision,
       false AS relative_url,
       form = 0 AS legacy_format,
       form = 4 AND page_id % 12 = 4 AS recursive
FROM p
"""

V_BASE = f"""
{E_BASE},
heads AS (SELECT origin, max(rev) AS head, CAST(substr(origin, 2) AS BIGINT) AS uid FROM revs GROUP BY origin),
visits AS (
  SELECT h.origin, CAST(v AS BIGINT) AS visit_no, CAST(v * 10 AS BIGINT) AS visit_rev,
         ['full', 'partial', 'failed', 'not_found'][(v + h.uid) % 4 + 1] AS status
  FROM heads h, range(1, h.head // 10 + 1) t(v)),
llr AS (
  SELECT h.origin, h.head, h.uid,
         coalesce((SELECT max(visit_rev) FROM visits v WHERE v.origin = h.origin
                   AND v.status IN ('full', 'partial')), -1) AS last_loaded_rev
  FROM heads h),
hc AS (SELECT origin, last_loaded_rev AS rev, uid % 7 <> 0 AS unaltered FROM llr WHERE last_loaded_rev >= 1),
plan AS (
  SELECT l.origin, l.head, l.uid, l.last_loaded_rev,
         CAST(CASE WHEN l.last_loaded_rev < 0 THEN 1 WHEN coalesce(hc.unaltered, true)
                   THEN l.last_loaded_rev + 1 ELSE 1 END AS BIGINT) AS start_rev,
         CAST(l.head AS BIGINT) AS end_rev
  FROM llr l LEFT JOIN hc ON hc.origin = l.origin)
"""

ORACLE_SQL["latest_visit"] = f"""
WITH {V_BASE}
SELECT origin, CAST(visit_no AS INTEGER) AS visit_no, status FROM visits v
WHERE visit_no = (SELECT max(visit_no) FROM visits w WHERE w.origin = v.origin)
"""

ORACLE_SQL["latest_snapshot_revision"] = f"""
WITH {V_BASE}
SELECT l.origin, l.last_loaded_rev AS rev, c.revision_id
FROM llr l JOIN chain c ON c.origin = l.origin AND c.rev = l.last_loaded_rev
"""

ORACLE_SQL["last_loaded_rev"] = f"WITH {V_BASE} SELECT origin, CAST(last_loaded_rev AS BIGINT) AS last_loaded_rev FROM llr"

ORACLE_SQL["history_check"] = f"WITH {V_BASE} SELECT origin, rev, unaltered FROM hc"

ORACLE_SQL["plan_range"] = f"""
WITH {V_BASE} SELECT origin, start_rev, end_rev, start_rev > end_rev AS uneventful FROM plan
"""

ORACLE_SQL["stale_check"] = f"""
WITH {V_BASE}
SELECT l.origin, l.head = l.last_loaded_rev AND coalesce(hc.unaltered, true) AS stale
FROM llr l LEFT JOIN hc ON hc.origin = l.origin
"""

ORACLE_SQL["incremental_equals_full"] = f"""
WITH {E_BASE},
heads AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin)
SELECT c.origin, c.rev, c.revision_id FROM chain c JOIN heads h ON h.origin = c.origin
WHERE c.rev > h.head // 2
"""

O_BASE = f"""
o AS (SELECT *, 'c' || CAST(o_custkey AS VARCHAR) AS origin,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rev
      FROM orders),
li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                                    l_suppkey, l_extendedprice) AS line FROM lineitem),
j AS (SELECT o.origin, o.rev, o.o_orderkey, o.o_orderstatus, li.* FROM li JOIN o ON li.l_orderkey = o.o_orderkey),
puts AS (SELECT origin, rev, 'p' || CAST(l_partkey % 50 AS VARCHAR) || '/' || l_returnflag || '/' || CAST(line AS VARCHAR) AS path,
                {git_sha('blob', "hex(CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR))")} AS blob_id
         FROM j),
cp AS (SELECT origin, rev, 'tags/o' || CAST(o_orderkey AS VARCHAR) AS dst, 'p' || CAST(l_partkey % 50 AS VARCHAR) AS src
       FROM j WHERE line = 1 AND o_orderstatus = 'F' AND rev > 1),
revs AS (SELECT origin, rev FROM o)
"""

ORACLE_SQL["expand_copies"] = f"""
WITH {O_BASE}
SELECT cp.origin, cp.rev, cp.dst || substr(p.path, strlen(cp.src) + 1) AS path, arg_max(p.blob_id, p.rev) AS blob_id
FROM cp JOIN puts p ON p.origin = cp.origin AND starts_with(p.path, cp.src || '/') AND p.rev <= cp.rev - 1
GROUP BY cp.origin, cp.rev, cp.dst, cp.src, p.path
"""

ORACLE_SQL["copy_filter"] = f"""
WITH {O_BASE}
SELECT origin, rev, dst AS path, src AS copyfrom_path, CAST(rev - 1 AS BIGINT) AS copyfrom_rev FROM cp
"""

ORACLE_SQL["low_water_mark"] = f"""
WITH {O_BASE}
SELECT r.origin, r.rev, coalesce((SELECT min(cp.rev - 1) FROM cp WHERE cp.origin = r.origin AND cp.rev = r.rev), r.rev + 1) AS low_water_mark
FROM revs r
"""

ORACLE_SQL["has_changes"] = f"""
WITH {O_BASE},
ch AS (SELECT origin, rev, path, false AS is_copy FROM puts UNION ALL SELECT origin, rev, dst, true FROM cp)
SELECT r.origin, r.rev, coalesce(bool_or(starts_with(ch.path, '{'p4'}') OR (ch.is_copy AND starts_with('{'p4'}', ch.path))), false) AS has_changes
FROM revs r LEFT JOIN ch ON ch.origin = r.origin AND ch.rev = r.rev
GROUP BY r.origin, r.rev
"""

ORACLE_SQL["root_projection"] = f"""
WITH {O_BASE},
em AS (SELECT DISTINCT origin, rev FROM (
         SELECT origin, rev FROM puts WHERE starts_with(path, 'p4')
         UNION ALL SELECT origin, rev FROM cp WHERE starts_with(dst, 'p4') OR starts_with('p4', dst))),
st AS (SELECT e.origin, e.rev AS at_rev, p.path, arg_max(p.blob_id, p.rev) AS blob_id
       FROM em e JOIN puts p ON p.origin = e.origin AND p.rev <= e.rev AND starts_with(p.path, 'p4/')
       GROUP BY e.origin, e.rev, p.path),
st2 AS (SELECT origin, at_rev, split_part(path, '/', 2) AS flag, split_part(path, '/', 3) AS fname, blob_id FROM st),
ft AS (SELECT origin, at_rev, flag, string_agg(hex('100644 ' || fname) || '00' || blob_id, '' ORDER BY fname) AS body
       FROM st2 GROUP BY origin, at_rev, flag),
fti AS (SELECT origin, at_rev, flag, {git_sha('tree', 'body')} AS tree_id FROM ft),
rt AS (SELECT origin, at_rev, string_agg(hex('40000 ' || flag) || '00' || tree_id, '' ORDER BY flag || '/') AS body
       FROM fti GROUP BY origin, at_rev)
SELECT e.origin, e.rev, coalesce({git_sha('tree', 'rt.body')}, {EMPTY}) AS tree_id
FROM em e LEFT JOIN rt ON rt.origin = e.origin AND rt.at_rev = e.rev
"""

# dumps: the text of every record, cut off at the quota
def _prop(name, value):
    return f"'K {len(name)}' || chr(10) || '{name}' || chr(10) || 'V ' || CAST(strlen({value}) AS VARCHAR) || chr(10) || {value} || chr(10)"


E_DUMPS = f"""
{E_BASE},
texts AS (
  SELECT *, CASE WHEN event_id % 5 = 0 THEN 'Revision-number: ' || CAST(event_id AS VARCHAR) || chr(10) || 'Content-length: 9' || chr(10) || chr(10)
    || 'Node-path: x' || chr(10) || chr(10) || 'Node-path: y' || chr(10) || 'Content-length: 99999' || chr(10) || chr(10) || 'end' ELSE data END AS content
  FROM ch),
bodies AS (SELECT *, {_prop('svn:author', 'event_type')} || {_prop('svn:log', "('event ' || CAST(event_id AS VARCHAR))")} || 'PROPS-END' || chr(10) AS body FROM texts),
recs AS (
  SELECT origin, rev, 0 AS no, 'Revision-number: ' || CAST(rev AS VARCHAR) || chr(10) || 'Prop-content-length: ' || CAST(strlen(body) AS VARCHAR) || chr(10)
           || 'Content-length: ' || CAST(strlen(body) AS VARCHAR) || chr(10) || chr(10) AS head, body AS held, '' AS tail FROM bodies
  UNION ALL
  SELECT origin, rev, 1, 'Node-path: ' || dname || CASE WHEN op = 'deldir' THEN '' ELSE '/' || fname END || chr(10) || 'Node-kind: '
           || CASE WHEN op = 'deldir' THEN 'dir' ELSE 'file' END || chr(10) || 'Node-action: ' || CASE WHEN op = 'put' THEN 'change' ELSE 'delete' END
           || CASE WHEN op = 'put' THEN chr(10) || 'Text-content-length: ' || CAST(strlen(content) AS VARCHAR) || chr(10)
              || 'Content-length: ' || CAST(strlen(content) AS VARCHAR) ELSE '' END || chr(10) || chr(10),
         CASE WHEN op = 'put' THEN content ELSE '' END, CASE WHEN op = 'put' THEN chr(10) ELSE '' END FROM bodies),
spots AS (
  SELECT *, strlen(head || held || tail) + 1 AS size, strlen('SVN-fs-dump-format-version: 2' || chr(10) || chr(10) || 'UUID: ' || {UUID.format(o='origin')} || chr(10) || chr(10))
    + coalesce(sum(strlen(head || held || tail) + 1) OVER (PARTITION BY origin ORDER BY rev, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM recs),
cuts AS (
  SELECT *, start + size <= {DUMP_QUOTA} AS whole,
         CASE WHEN start + size <= {DUMP_QUOTA} THEN head || held || tail
              WHEN start + 1 < {DUMP_QUOTA} THEN rtrim(substr(head || held || tail, 1, CAST({DUMP_QUOTA} - start - 1 AS BIGINT)), chr(10)) ELSE '' END AS cut FROM spots),
got AS (
  SELECT *, whole OR (contains(cut, chr(10) || chr(10)) AND strlen(head) + strlen(held) <= strlen(cut) + 1) AS complete,
         contains(cut, chr(10) || chr(10)) AS headed, regexp_matches(cut, '^(Revision-number: [0-9]|Node-path: )') AS seen FROM cuts WHERE cut <> '')
"""

ORACLE_SQL["dump_frames"] = f"""
WITH {E_DUMPS},
per AS (SELECT origin, bool_and(complete) AS whole, count(*) FILTER (complete) AS n_records, max(rev) AS last, arg_max(no, start) AS last_no,
               arg_max(seen, start) AS last_seen FROM got GROUP BY origin),
m AS (SELECT *, CASE WHEN whole THEN last WHEN last_no = 0 AND NOT last_seen THEN last - 2 ELSE last - 1 END AS upto FROM per)
SELECT origin, n_records, NOT whole AS truncated, CASE WHEN upto > 0 THEN upto END AS max_complete_rev FROM m
"""

ORACLE_SQL["dump_log_status"] = f"""
WITH {E_DUMPS},
{V_BASE[V_BASE.index("heads AS"):]},
revd AS (SELECT origin, rev, bool_and(whole) AS whole FROM cuts GROUP BY origin, rev),
d AS (SELECT origin, max(rev) FILTER (whole) AS last_dumped, NOT bool_and(whole) AS short FROM revd GROUP BY origin),
asked AS (SELECT origin FROM revs UNION SELECT 'u' || CAST(CAST(substr(origin, 2) AS BIGINT) + 1 AS VARCHAR) FROM revs),
j AS (
  SELECT a.origin, d.last_dumped, l.last_loaded_rev,
         CASE WHEN d.origin IS NULL THEN 'E170013' WHEN d.short THEN 'E000028' ELSE '' END AS error_codes,
         CASE WHEN d.origin IS NULL THEN 'svnrdump: E170013: Unable to connect to a repository at URL ''file:///repos/' || a.origin || ''''
              WHEN d.short THEN 'svnrdump: E000028: Can''t write to stream: No space left on device' ELSE '' END AS errors
  FROM asked a LEFT JOIN d ON d.origin = a.origin LEFT JOIN llr l ON l.origin = a.origin)
SELECT origin, last_dumped, error_codes, errors,
       CASE WHEN error_codes = '' THEN 'complete' WHEN coalesce(last_dumped, -1) > coalesce(last_loaded_rev, -1) THEN 'partial'
            WHEN coalesce(last_dumped, -1) <> -1 AND last_dumped < coalesce(last_loaded_rev, -1) THEN 'behind_archive'
            WHEN error_codes LIKE '%E170013%' THEN 'not_found' ELSE 'error' END AS outcome
FROM j
"""

ORACLE_SQL["classify_dump_error"] = f"""
WITH {E_DUMPS}
SELECT origin, CASE WHEN no = 1 AND headed THEN 'E200014' ELSE 'E140001' END AS code, no = 1 AND headed AS partial_possible
FROM got WHERE NOT complete AND seen
"""

ORACLE_SQL["export_snapshot"] = f"""
WITH {E_BASE},
head AS (SELECT origin, max(rev) AS rev FROM revs GROUP BY origin),
b AS (SELECT h.origin, h.rev, 'rev_' || CAST(h.rev AS VARCHAR) AS name, t.tree_id
      FROM head h JOIN rtid t ON t.origin = h.origin AND t.rev = h.rev)
SELECT origin, rev, {git_sha('snapshot', "hex('alias HEAD') || '00' || hex(CAST(strlen(name) AS VARCHAR) || ':') || hex(name) || hex('directory ' || name) || '00' || hex('20:') || tree_id")} AS snapshot_id
FROM b
"""

E_LISTING = f"""
{E_BASE},
head AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin),
lst AS (
  SELECT f.origin, f.at_rev, f.dname || '/' || f.fname AS path, 'file' AS kind, f.blob_id AS id FROM falive f
  UNION ALL SELECT origin, at_rev, dname, 'dir', tree_id FROM dtid)
"""

# only the last two revisions of each origin are listed
_LAST_TWO = E_LISTING.replace(
    "revs AS (SELECT origin, rev FROM ev)",
    "revs AS (SELECT origin, rev FROM ev QUALIFY rev >= max(rev) OVER (PARTITION BY origin) - 1)")
ORACLE_SQL["out_of_order"] = f"WITH {E_BASE} SELECT origin, rev, revision_id FROM chain"

ORACLE_SQL["emit_filter"] = f"""
WITH {O_BASE}
SELECT DISTINCT origin, rev FROM (
  SELECT origin, rev FROM puts WHERE starts_with(path, 'p4')
  UNION ALL SELECT origin, rev FROM cp WHERE starts_with(dst, 'p4') OR starts_with('p4', dst))
"""

ORACLE_SQL["alternate_urls"] = """
WITH u AS (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN regexp_replace(url, '://[^/?#]*', '://svn.example.net')
                                ELSE url END AS url FROM pages)
SELECT page_id, 0 AS pos, CASE WHEN page_id % 4 = 0 THEN regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:', 'svn:') ELSE url END AS url FROM u
UNION ALL SELECT page_id, 1, url FROM u WHERE page_id % 4 = 0
"""

ORACLE_SQL["redirect_target"] = """
SELECT page_id, CASE WHEN page_id % 3 = 2 THEN NULL ELSE url END AS target FROM pages
"""

ORACLE_SQL["root_directory"] = """
SELECT page_id, regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g') AS root_directory
FROM pages
"""

E_PROPS = f"""
{E_BASE},
pe AS (
  SELECT origin, rev, dname || '/' || fname AS path,
         CASE WHEN event_type = 'click' THEN 'svn:eol-style' WHEN event_type = 'purchase' THEN 'svn:executable'
              WHEN event_type = 'view' AND CAST(substr(fname, 2) AS INTEGER) % 3 = 0 THEN 'svn:executable' END AS name,
         CASE WHEN event_type = 'click' THEN ['native', 'LF', 'CRLF', 'CR', 'bogus'][CAST(substr(fname, 2) AS INTEGER) % 5 + 1]
              WHEN event_type = 'purchase' THEN '*' END AS value
  FROM ch),
files AS (SELECT DISTINCT origin, dname, dname || '/' || fname AS path FROM ch WHERE op <> 'deldir'),
kills AS (SELECT origin, dname || '/' || fname AS path, rev FROM ch WHERE op = 'delfile'
          UNION ALL
          SELECT c.origin, f.path, c.rev FROM ch c JOIN files f ON f.origin = c.origin AND f.dname = c.dname
          WHERE c.op = 'deldir'),
putsp AS (SELECT origin, dname || '/' || fname AS path, rev FROM ch WHERE op = 'put'),
pe2 AS (
  SELECT pe.*,
    (SELECT min(p.rev) FROM putsp p WHERE p.origin = pe.origin AND p.path = pe.path AND p.rev <= pe.rev
       AND p.rev > coalesce((SELECT max(k.rev) FROM kills k WHERE k.origin = pe.origin AND k.path = pe.path
                             AND k.rev < pe.rev), 0)) AS life_from,
    (SELECT min(k.rev) FROM kills k WHERE k.origin = pe.origin AND k.path = pe.path AND k.rev > pe.rev) AS life_to
  FROM pe WHERE name IS NOT NULL),
pst AS (
  SELECT * FROM (
    SELECT origin, path, name, value, rev AS from_rev,
           coalesce(lead(rev) OVER (PARTITION BY origin, path, life_from, name ORDER BY rev), life_to) AS to_rev
    FROM pe2) WHERE value IS NOT NULL),
head AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin)
"""

ORACLE_SQL["prop_state"] = f"WITH {E_PROPS} SELECT origin, path, name, value, from_rev, to_rev FROM pst"

# the same state rules, on contents that links and line endings change
_DATA = "event_type || ' ' || CAST(event_id AS VARCHAR) AS data"
_EXPORT_DATA = """CASE event_id % 3 WHEN 0 THEN 'link ' || CAST(event_id AS VARCHAR)
       WHEN 1 THEN event_type || chr(13) || chr(10) || CAST(event_id AS VARCHAR) || chr(10)
       ELSE event_type || ' ' || CAST(event_id AS VARCHAR) END AS data"""
_SPECIAL = """FROM ch
  UNION ALL
  SELECT origin, rev, dname || '/' || fname, 'svn:special', CASE WHEN event_type = 'view' THEN '*' END
  FROM ch WHERE event_type IN ('view', 'purchase') AND CAST(substr(fname, 2) AS INTEGER) % 3 = 1),
files AS"""
E_EXPORT = E_PROPS.replace(_DATA, _EXPORT_DATA).replace("FROM ch),\nfiles AS", _SPECIAL) + f""",
force AS (
  SELECT f.origin, f.at_rev, f.dname, f.fname, f.put_rev, max(p.value) FILTER (p.name = 'svn:eol-style') AS eol,
         bool_or(p.name = 'svn:executable') AS exe, bool_or(p.name = 'svn:special') AS special
  FROM falive f LEFT JOIN pst p ON p.origin = f.origin AND p.path = f.dname || '/' || f.fname
    AND p.from_rev <= f.at_rev AND (p.to_rev IS NULL OR f.at_rev < p.to_rev)
  GROUP BY ALL),
xf AS (
  SELECT force.*, coalesce(special, false) AND starts_with(data, 'link ') AS link, data FROM force
  JOIN ch ON ch.origin = force.origin AND ch.rev = force.put_rev),
xo AS (
  SELECT origin, at_rev, dname, fname, CASE WHEN link THEN '120000' WHEN exe THEN '100755' ELSE '100644' END AS mode,
         CASE WHEN link THEN substr(data, 6)
              WHEN eol IN ('native', 'LF') THEN replace(data, chr(13) || chr(10), chr(10))
              WHEN eol = 'CRLF' THEN replace(replace(data, chr(13) || chr(10), chr(10)), chr(10), chr(13) || chr(10))
              WHEN eol = 'CR' THEN replace(replace(data, chr(13) || chr(10), chr(10)), chr(10), chr(13))
              ELSE data END AS content
  FROM xf),
xi AS (SELECT *, {git_sha('blob', 'hex(content)')} AS id FROM xo),
xd AS (
  SELECT d.origin, d.at_rev, d.dname,
         coalesce(string_agg(hex(f.mode || ' ' || f.fname) || '00' || f.id, '' ORDER BY f.fname), '') AS body
  FROM dalive d LEFT JOIN xi f ON f.origin = d.origin AND f.at_rev = d.at_rev AND f.dname = d.dname
  GROUP BY d.origin, d.at_rev, d.dname),
xt AS (SELECT origin, at_rev, dname, {git_sha('tree', 'body')} AS tree_id FROM xd),
xr AS (
  SELECT r.origin, r.rev, coalesce(string_agg(hex('40000 ' || t.dname) || '00' || t.tree_id, '' ORDER BY t.dname || '/'), '') AS body
  FROM revs r LEFT JOIN xt t ON t.origin = r.origin AND t.at_rev = r.rev
  GROUP BY r.origin, r.rev)
"""
ORACLE_SQL["tree_ids_with_props"] = f"WITH {E_EXPORT} SELECT origin, rev, {git_sha('tree', 'body')} AS tree_id FROM xr"

ORACLE_SQL["export_modes"] = f"""
WITH {E_EXPORT}
SELECT x.origin, x.dname || '/' || x.fname AS path, x.id AS blob_id,
       CASE x.mode WHEN '120000' THEN 40960 WHEN '100755' THEN 33261 ELSE 33188 END AS perms
FROM xi x JOIN head h ON h.origin = x.origin AND x.at_rev = h.head
"""

ORACLE_SQL["apply_executable"] = f"""
WITH {E_PROPS},
ex AS (SELECT DISTINCT p.origin, p.path FROM pst p JOIN head h ON h.origin = p.origin
       WHERE p.name = 'svn:executable' AND p.from_rev <= h.head AND (p.to_rev IS NULL OR h.head < p.to_rev))
SELECT f.origin, f.dname || '/' || f.fname AS path,
       CASE WHEN ex.path IS NOT NULL THEN 33261 ELSE 33188 END AS perms
FROM falive f JOIN head h ON h.origin = f.origin AND f.at_rev = h.head
LEFT JOIN ex ON ex.origin = f.origin AND ex.path = f.dname || '/' || f.fname
"""

ORACLE_SQL["decode_props"] = """
SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE length(text) END AS BIGINT) AS value_chars FROM documents
"""

# externals: every line as a row, then the state at every revision
INF = "9223372036854775807"


def _line(no, cond, path, line, url, user, sub, revision="NULL", peg="NULL", relative="false", legacy="false", recursive="false",
          bad="false", on="dir"):
    """One line of the adapter's values as SELECT on xi."""
    return f"""
  SELECT origin, dir, rev AS from_rev, to_rev, {no} AS line_no, {path} AS path, {line} AS line, {url} AS url, 'u' || CAST({user} AS VARCHAR) AS t_origin,
         {sub} AS t_sub, CAST({revision} AS BIGINT) AS revision, CAST({peg} AS BIGINT) AS peg, {relative} AS relative, {legacy} AS legacy,
         {recursive} AS recursive, {bad} AS bad
  FROM xi WHERE is_set AND {"dir <> ''" if on == "dir" else "dir = ''"} AND {cond}"""


def _repo(n):
    return f"'file:///repos/u' || CAST(uid + {n} AS VARCHAR)"


_NEAR = f"{_repo(1)} || '/d' || CAST((j + 1) % 10 AS VARCHAR)"
_NEAR_SUB = "'d' || CAST((j + 1) % 10 AS VARCHAR)"
_J = "CAST(j AS VARCHAR)"
_OVER = "'f' || CAST(k AS VARCHAR)"
_LINES = "  UNION ALL".join([
    _line(1, "true", "'ext/lib'", f"'ext/lib ' || {_NEAR}", _NEAR, "uid + 1", _NEAR_SUB, legacy="true"),
    _line(3, "event_id % 2 = 0", "'pinned'", f"'-r3 ' || {_repo(2)} || '/d0 pinned'", f"{_repo(2)} || '/d0'", "uid + 2", "'d0'", revision=3),
    _line(4, "event_id % 3 = 0", _OVER, f"{_OVER} || ' ' || {_NEAR}", _NEAR, "uid + 1", _NEAR_SUB, legacy="true"),
    _line(5, "event_id % 4 = 1", "'ext/lib'", f"{_repo(2)} || '/d5 ext/lib'", f"{_repo(2)} || '/d5'", "uid + 2", "'d5'"),
    _line(6, "event_id % 5 = 0", "'peg'", f"'-r2 ' || {_repo(3)} || '/d1@4 peg'", f"{_repo(3)} || '/d1'", "uid + 3", "'d1'", revision=2, peg=4),
    _line(7, "event_id % 7 = 0", "'rel/two'", "'../../u' || CAST(uid + 1 AS VARCHAR) || '/d2 rel/two'", f"{_repo(1)} || '/d2'", "uid + 1", "'d2'",
          relative="true"),
    _line(8, "event_id % 23 = 0", "'self'", f"{_repo(0)} || ' self'", _repo(0), "uid", "''", recursive="true"),
    _line(9, "event_id % 13 = 0", "NULL", "'-rx file:///repos/u1/d1 broken'", "NULL", "NULL", "NULL", bad="true"),
    _line(1, "true", f"'d' || {_J} || '/own'", f"{_repo(1)} || '/d4 d' || {_J} || '/own'", f"{_repo(1)} || '/d4'", "uid + 1", "'d4'", on="root"),
    _line(2, "event_id % 2 = 0", "'lib'", f"'lib -r1 ' || {_repo(2)}", _repo(2), "uid + 2", "''", revision=1, legacy="true", on="root"),
    _line(3, "event_id % 3 = 0", f"'d' || {_J} || '/ext/lib'", f"{_repo(1)} || '/d4 d' || {_J} || '/ext/lib'", f"{_repo(1)} || '/d4'", "uid + 1",
          "'d4'", on="root"),
])
_SAME = "origin, path, url, rk, pk, relative, legacy"


def _equal(a, b):
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in _SAME.split(", "))


E_EXT = f"""
{E_BASE},
users AS (SELECT origin, max(rev) AS latest FROM revs GROUP BY origin),
xe AS (
  SELECT origin, rev, ts, CASE WHEN event_type = 'view' THEN dname ELSE '' END AS dir, CAST(substr(origin, 2) AS BIGINT) AS uid,
         CAST(substr(dname, 2) AS INTEGER) AS j, event_id, CAST(substr(fname, 2) AS INTEGER) AS k,
         CAST(substr(fname, 2) AS INTEGER) % 10 IN (7, 9) AS is_set
  FROM ch WHERE (event_type = 'view' AND CAST(substr(fname, 2) AS INTEGER) % 10 IN (7, 8))
             OR (event_type = 'purchase' AND CAST(substr(fname, 2) AS INTEGER) % 10 IN (9, 6))),
xi AS (
  SELECT x.*,
    least(coalesce(lead(rev) OVER (PARTITION BY origin, dir ORDER BY rev), {INF}),
          coalesce((SELECT min(d.rev) FROM dd d WHERE d.origin = x.origin AND d.dname = x.dir AND d.rev > x.rev), {INF})) AS to_rev
  FROM xe x),
lines AS (
  SELECT *, bool_or(bad) OVER (PARTITION BY origin, dir, from_rev) AS void,
         coalesce(revision, -1) AS rk, coalesce(peg, -1) AS pk,
         CAST(row_number() OVER (PARTITION BY origin, dir, from_rev, path ORDER BY line_no) AS INTEGER) AS rank FROM ({_LINES})),
defs AS MATERIALIZED (SELECT * FROM lines WHERE NOT void),
gone AS (
  SELECT DISTINCT p.origin, p.dir, p.to_rev AS rev, p.path, p.url FROM defs p
  WHERE p.to_rev < {INF} AND NOT EXISTS (
    SELECT 1 FROM defs c WHERE c.dir = p.dir AND c.from_rev = p.to_rev AND c.origin = p.origin AND c.path = p.path AND c.url = p.url
      AND c.revision IS NOT DISTINCT FROM p.revision AND c.peg IS NOT DISTINCT FROM p.peg)),
usable AS MATERIALIZED (
  SELECT d.*, d.rank = 1 AND EXISTS (SELECT 1 FROM gone g WHERE g.origin = d.origin AND g.dir = d.dir AND g.rev = d.from_rev AND g.path = d.path) AS again
  FROM defs d WHERE NOT recursive),
exports AS (SELECT {_SAME}, min(from_rev) AS first_rev FROM usable GROUP BY {_SAME}
            UNION SELECT {_SAME}, from_rev FROM usable WHERE again),
marked AS (
  SELECT *, CASE WHEN again OR lag(to_rev) OVER w IS DISTINCT FROM from_rev THEN from_rev END AS starts
  FROM usable WINDOW w AS (PARTITION BY dir, {_SAME} ORDER BY from_rev)),
since AS (SELECT *, max(starts) OVER (PARTITION BY dir, {_SAME} ORDER BY from_rev) AS since FROM marked),
used AS MATERIALIZED (
  SELECT s.*, (SELECT max(e.first_rev) FROM exports e WHERE {_equal('e', 's')} AND e.first_rev <= s.since) AS export_rev
  FROM since s),
aimed AS (
  SELECT u.*, t.latest, CASE WHEN t.origin IS NOT NULL THEN u.t_origin END AS target_origin, CASE WHEN t.origin IS NOT NULL THEN u.t_sub END AS sub_path,
         coalesce(u.peg, CASE WHEN u.legacy THEN u.revision END, (SELECT max(e.rev) FROM ev e WHERE e.origin = u.t_origin AND e.ts <= h.ts)) AS at_peg
  FROM used u JOIN ev h ON h.origin = u.origin AND h.rev = u.export_rev LEFT JOIN users t ON t.origin = u.t_origin),
read_at AS (SELECT *, coalesce(revision, at_peg) AS target_rev FROM aimed),
alive AS (
  SELECT r.*, target_origin IS NOT NULL AND at_peg <= latest AND target_rev <= latest AND (sub_path = '' OR (
      EXISTS (SELECT 1 FROM dalive a WHERE a.origin = r.target_origin AND a.at_rev = r.target_rev AND a.dname = r.sub_path)
      AND EXISTS (SELECT 1 FROM dalive a WHERE a.origin = r.target_origin AND a.at_rev = r.at_peg AND a.dname = r.sub_path)
      AND NOT EXISTS (SELECT 1 FROM dd WHERE dd.origin = r.target_origin AND dd.dname = r.sub_path
                      AND dd.rev > least(r.at_peg, r.target_rev) AND dd.rev <= greatest(r.at_peg, r.target_rev)))) AS found
  FROM read_at r),
st AS MATERIALIZED (
  SELECT a.*, coalesce(found, false) AND NOT EXISTS (
    SELECT 1 FROM alive b WHERE NOT coalesce(b.found, false) AND {_equal('a', 'b')} AND b.export_rev <= a.export_rev) AS valid,
    CASE WHEN dir = '' THEN path ELSE dir || '/' || path END AS dest
  FROM alive a),
off AS (SELECT DISTINCT r.origin, r.rev FROM revs r JOIN defs d ON d.origin = r.origin AND d.recursive AND d.from_rev <= r.rev AND r.rev < d.to_rev),
effect AS MATERIALIZED (
  SELECT s.*, r.rev FROM st s JOIN revs r ON r.origin = s.origin AND s.from_rev <= r.rev AND r.rev < s.to_rev
  WHERE NOT EXISTS (SELECT 1 FROM off WHERE off.origin = r.origin AND off.rev = r.rev)),
grafts AS (
  SELECT e.origin, e.rev, e.dir, e.line_no, e.dest || CASE WHEN e.sub_path = '' THEN '/' || f.dname ELSE '' END || '/' || f.fname AS path, 'file' AS kind, f.blob_id AS id
  FROM effect e JOIN falive f ON f.origin = e.target_origin AND f.at_rev = e.target_rev AND (e.sub_path = '' OR f.dname = e.sub_path) WHERE e.valid
  UNION ALL SELECT e.origin, e.rev, e.dir, e.line_no, e.dest || '/' || d.dname, 'dir', NULL
  FROM effect e JOIN dalive d ON d.origin = e.target_origin AND d.at_rev = e.target_rev WHERE e.valid AND e.sub_path = ''
  UNION ALL SELECT origin, rev, dir, line_no, dest, 'dir', NULL FROM effect WHERE valid),
way AS (SELECT DISTINCT origin, rev, array_to_string(list_slice(string_split(dest, '/'), 1, n), '/') AS path
        FROM effect, range(1, 4) AS r(n) WHERE n < len(string_split(dest, '/'))),
cand AS (
  SELECT origin, rev, path, kind, id, 'external' AS source, 0 AS prio, -length(dir) AS a, -line_no AS b FROM grafts
  UNION ALL SELECT origin, at_rev, dname || '/' || fname, 'file', blob_id, 'versioned', 1, 0, 0 FROM falive
  UNION ALL SELECT origin, at_rev, dname, 'dir', NULL, 'versioned', 1, 0, 0 FROM dalive
  UNION ALL SELECT origin, rev, path, 'dir', NULL, 'parent', 2, 0, 0 FROM way),
nodes AS MATERIALIZED (
  SELECT origin, rev, path, kind, id, source FROM cand
  QUALIFY row_number() OVER (PARTITION BY origin, rev, path ORDER BY prio, a, b) = 1)
"""

ORACLE_SQL["externals_lines"] = f"WITH {E_EXT} SELECT origin, dir, from_rev, line_no, line FROM lines"

ORACLE_SQL["external_rank"] = f"WITH {E_EXT} SELECT origin, dir, from_rev, line_no, path, rank FROM lines WHERE NOT bad"

ORACLE_SQL["resolve_externals"] = f"""
WITH {E_EXT} SELECT origin, dir, from_rev, line_no, export_rev, target_origin, sub_path, target_rev, CASE WHEN valid THEN sub_path END AS node FROM st
"""

ORACLE_SQL["classify_external"] = f"""
WITH {E_EXT}
SELECT l.origin, l.dir, l.from_rev, l.line_no,
       CASE WHEN l.void THEN 'unparsable' WHEN l.recursive THEN 'recursive' WHEN s.valid THEN 'valid' ELSE 'dead' END AS status
FROM lines l LEFT JOIN st s ON s.origin = l.origin AND s.dir = l.dir AND s.from_rev = l.from_rev AND s.line_no = l.line_no
"""

ORACLE_SQL["dedupe_externals"] = f"""
WITH {E_EXT}
SELECT origin, path, url, coalesce(revision, -1) AS revision, coalesce(peg, -1) AS peg_revision, export_rev, count(*) AS n_uses, count(DISTINCT dir) AS n_dirs
FROM st GROUP BY ALL
"""

ORACLE_SQL["externals_flags"] = f"""
WITH {E_EXT}
SELECT r.origin, r.rev, EXISTS (SELECT 1 FROM effect e WHERE e.origin = r.origin AND e.rev = r.rev AND e.valid AND e.relative) AS has_relative,
       EXISTS (SELECT 1 FROM off WHERE off.origin = r.origin AND off.rev = r.rev) AS has_recursive
FROM revs r
"""

ORACLE_SQL["externals_removed"] = f"WITH {E_EXT} SELECT origin, dir, rev, path, url FROM gone"


def _runs(rows: str, key: str) -> str:
    """Runs of consecutive revisions of (origin, rev, key) rows; the last revision of an origin leaves a run open."""
    return f"""
SELECT w.origin, {key}, min(w.rev) AS from_rev, CASE WHEN max(w.rev) < any_value(u.latest) THEN max(w.rev) + 1 END AS to_rev
FROM (SELECT *, rev - row_number() OVER (PARTITION BY origin, {key} ORDER BY rev) AS run FROM ({rows})) w JOIN users u ON u.origin = w.origin
GROUP BY w.origin, {key}, run
"""


ORACLE_SQL["external_paths"] = f"""
WITH {E_EXT},
steps AS (SELECT DISTINCT origin, rev, array_to_string(list_slice(string_split(dest, '/'), 1, n), '/') AS path, dir
          FROM effect, range(1, 5) AS r(n) WHERE valid AND n <= len(string_split(dest, '/')))
{_runs("SELECT origin, rev, path FROM grafts UNION SELECT origin, rev, path FROM steps WHERE length(path) > length(dir)", "path")}
"""

ORACLE_SQL["external_owner"] = f"""
WITH {E_EXT},
live AS (SELECT DISTINCT origin, dir, dest, rev FROM effect WHERE valid),
ends AS (SELECT l.origin, l.dir, l.dest, l.rev + 1 AS rev FROM live l JOIN revs r ON r.origin = l.origin AND r.rev = l.rev + 1
         WHERE NOT EXISTS (SELECT 1 FROM live m WHERE m.origin = l.origin AND m.dir = l.dir AND m.dest = l.dest AND m.rev = l.rev + 1)),
owned AS (SELECT origin, rev, dir, path FROM grafts
          UNION SELECT origin, rev, dir, array_to_string(list_slice(string_split(dest, '/'), 1, n), '/')
          FROM effect, range(1, 5) AS r(n) WHERE valid AND n <= len(string_split(dest, '/')))
SELECT e.origin, e.dir, e.dest, e.rev, e.dir <> '' AND EXISTS (
  SELECT 1 FROM owned o WHERE o.origin = e.origin AND o.rev = e.rev AND o.dir = '' AND o.path = e.dest) AS stays
FROM ends e
"""

ORACLE_SQL["overlay_externals"] = f"WITH {E_EXT} " + _runs("SELECT origin, rev, path, kind, id, source FROM nodes", "path, kind, id, source")

ORACLE_SQL["delete_cascade_externals"] = f"""
WITH {E_EXT},
cut AS (SELECT d.origin, d.dname AS deleted, d.rev FROM dd d
        JOIN dalive a ON a.origin = d.origin AND a.dname = d.dname AND a.at_rev = d.rev - 1)
SELECT c.origin, c.deleted, c.rev, n.path, n.source, EXISTS (
  SELECT 1 FROM nodes m WHERE m.origin = c.origin AND m.rev = c.rev AND m.path = n.path AND m.kind = n.kind AND m.id IS NOT DISTINCT FROM n.id
    AND m.source = n.source) AS survives
FROM cut c JOIN nodes n ON n.origin = c.origin AND n.rev = c.rev - 1 AND starts_with(n.path, c.deleted || '/')
"""


def _tree_ctes(nodes: str, depth: int) -> str:
    """CTEs lvl<depth - 1> .. lvl0 with the tree id of every directory of ``nodes`` (origin, rev, path, kind, id, mode), the root as ''."""
    out = f"""
placed AS MATERIALIZED (
  SELECT *, len(string_split(path, '/')) AS depth, regexp_extract(path, '([^/]*)$', 1) AS name,
         CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '' END AS parent FROM {nodes})"""
    for d in range(depth - 1, -1, -1):
        dirs = "SELECT origin, rev, '' AS path FROM revs" if d == 0 else f"SELECT origin, rev, path FROM placed WHERE kind = 'dir' AND depth = {d}"
        below = f"SELECT origin, rev, parent, name, mode, id, name AS place FROM placed WHERE kind = 'file' AND depth = {d + 1}"
        if d < depth - 1:
            below += f""" UNION ALL SELECT p.origin, p.rev, p.parent, p.name, '40000', l.id, p.name || '/'
            FROM lvl{d + 1} l JOIN placed p ON p.origin = l.origin AND p.rev = l.rev AND p.path = l.path"""
        out += f""",
lvl{d} AS MATERIALIZED (
  SELECT t.origin, t.rev, t.path, {git_sha('tree', 'body')} AS id FROM (
    SELECT d.origin, d.rev, d.path, coalesce(string_agg(hex(c.mode || ' ' || c.name) || '00' || c.id, '' ORDER BY c.place) FILTER (c.name IS NOT NULL), '') AS body
    FROM ({dirs}) d LEFT JOIN ({below}) c ON c.origin = d.origin AND c.rev = d.rev AND c.parent = d.path GROUP BY d.origin, d.rev, d.path) t)"""
    return out


ORACLE_SQL["externals_tree"] = f"""
WITH {E_EXT},
moded AS (SELECT *, '100644' AS mode FROM nodes),{_tree_ctes('moded', 5)}
SELECT origin, rev, id AS tree_id FROM lvl0
"""

# orders: every file at every revision, tags as copied
O_TREES = f"""
{O_BASE},
held AS (
  SELECT r.origin, r.rev, p.path, arg_max(p.blob_id, p.rev) AS id FROM revs r JOIN puts p ON p.origin = r.origin AND p.rev <= r.rev GROUP BY r.origin, r.rev, p.path
  UNION ALL
  SELECT r.origin, r.rev, c.dst || substr(p.path, length(c.src) + 1), arg_max(p.blob_id, p.rev)
  FROM cp c JOIN puts p ON p.origin = c.origin AND p.rev < c.rev AND starts_with(p.path, c.src || '/') JOIN revs r ON r.origin = c.origin AND r.rev >= c.rev
  GROUP BY r.origin, r.rev, c.dst, c.src, p.path),
moded AS MATERIALIZED (
  SELECT origin, rev, path, 'file' AS kind, id, '100644' AS mode FROM held
  UNION ALL SELECT DISTINCT origin, rev, array_to_string(list_slice(string_split(path, '/'), 1, n), '/'), 'dir', NULL, NULL
  FROM held, range(1, 4) AS r(n) WHERE n < len(string_split(path, '/'))),{_tree_ctes('moded', 4)}
"""

ORACLE_SQL["orders_tree_ids"] = f"WITH {O_TREES} SELECT origin, rev, id AS tree_id FROM lvl0"


def _chain(meta: str) -> str:
    """Revision ids of ``meta`` (origin, rev, tree_id, who, tail), each with the one before as its parent."""
    body = "author ' || {0}who || chr(10) || 'committer ' || {0}who || chr(10) || {0}tail)"
    first = git_sha("commit", "hex('tree ' || tree_id || chr(10) || '" + body.format(""))
    later = git_sha("commit", "hex('tree ' || m.tree_id || chr(10) || 'parent ' || c.revision_id || chr(10) || '" + body.format("m."))
    return f"""
SELECT * FROM (
  WITH RECURSIVE c(origin, rev, revision_id) AS (
    SELECT origin, rev, {first} FROM {meta} WHERE rev = 1
    UNION ALL SELECT m.origin, m.rev, {later} FROM {meta} m JOIN c ON m.origin = c.origin AND m.rev = c.rev + 1)
  SELECT * FROM c)"""


ORACLE_SQL["incremental_orders_equals_full"] = f"""
WITH {O_TREES},
signed AS (
  SELECT l.origin, l.rev, l.id AS tree_id, 'customer' || CAST(o.o_custkey AS VARCHAR) || ' ' || {STAMP.format(ts='CAST(o.o_orderdate AS TIMESTAMP)')} || ' +0000' AS who,
         'svn_repo_uuid ' || {UUID.format(o='l.origin')} || chr(10) || 'svn_revision ' || CAST(l.rev AS VARCHAR) || chr(10) || chr(10) || 'order '
           || CAST(o.o_orderkey AS VARCHAR) AS tail
  FROM lvl0 l JOIN o ON o.origin = l.origin AND o.rev = l.rev),
ids AS ({_chain('signed')}),
heads AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin)
SELECT i.origin, i.rev, i.revision_id FROM ids i JOIN heads h ON h.origin = i.origin WHERE i.rev > h.head // 2
"""

ORACLE_SQL["incremental_export_equals_full"] = f"""
WITH {E_EXPORT},
signed AS (SELECT m.origin, m.rev, {git_sha('tree', 'x.body')} AS tree_id, m.who, m.tail FROM meta m JOIN xr x ON x.origin = m.origin AND x.rev = m.rev),
ids AS ({_chain('signed')})
SELECT i.origin, i.rev, i.revision_id FROM ids i JOIN head h ON h.origin = i.origin WHERE i.rev > h.head // 2
"""

ORACLE_SQL["copied_modes"] = f"""
WITH {O_BASE},
texts AS (
  SELECT j.*, 'p' || CAST(l_partkey % 50 AS VARCHAR) || '/' || l_returnflag || '/' || CAST(line AS VARCHAR) AS path,
         CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) AS base FROM j),
files AS (
  SELECT *, CASE l_partkey % 3 WHEN 0 THEN 'link ' || base WHEN 1 THEN base || chr(13) || chr(10) || CAST(l_suppkey AS VARCHAR) || chr(10) ELSE base END AS data
  FROM texts),
events AS (
  SELECT origin, rev, path, 'exe' AS name, CASE WHEN l_suppkey % 4 = 0 THEN '*' END AS value FROM files WHERE l_suppkey % 4 IN (0, 1)
  UNION ALL SELECT origin, rev, path, 'special', CASE WHEN line % 2 = 1 THEN '*' END FROM files WHERE l_partkey % 3 = 0
  UNION ALL SELECT origin, rev, path, 'eol', ['native', 'LF', 'CRLF', 'CR', 'bogus'][CAST(l_suppkey % 5 AS INTEGER) + 1] FROM files WHERE l_partkey % 3 = 1),
taken AS (
  SELECT c.origin, c.rev, c.dst, substr(f.path, length(c.src) + 2) AS rel, f.path, arg_max(f.data, f.rev) AS data
  FROM cp c JOIN files f ON f.origin = c.origin AND f.rev < c.rev AND starts_with(f.path, c.src || '/') GROUP BY c.origin, c.rev, c.dst, c.src, f.path),
valued AS (
  SELECT t.*, v.name, v.value FROM taken t LEFT JOIN LATERAL (
    SELECT e.name, arg_max(coalesce(e.value, ''), e.rev) AS value FROM events e WHERE e.origin = t.origin AND e.path = t.path AND e.rev < t.rev GROUP BY e.name) v ON true),
state AS (
  SELECT origin, rev, dst, rel, data, max(value) FILTER (name = 'eol') AS eol,
         coalesce(bool_or(name = 'exe' AND value = '*'), false) AND rel NOT IN ('A/1', 'N/1', 'R/1') AS exe,
         coalesce(bool_or(name = 'special' AND value = '*'), false) AND starts_with(data, 'link ') AS link
  FROM valued GROUP BY origin, rev, dst, rel, data),
written AS (
  SELECT origin, rev, dst, rel, CASE WHEN link THEN 40960 WHEN exe THEN 33261 ELSE 33188 END AS perms,
         CASE WHEN link THEN substr(data, 6)
              WHEN eol IN ('native', 'LF') THEN replace(data, chr(13) || chr(10), chr(10))
              WHEN eol = 'CRLF' THEN replace(replace(data, chr(13) || chr(10), chr(10)), chr(10), chr(13) || chr(10))
              WHEN eol = 'CR' THEN replace(replace(data, chr(13) || chr(10), chr(10)), chr(10), chr(13)) ELSE data END AS content
  FROM state),
steps AS (
  SELECT origin, rev, dst, perms, rel, content FROM written
  UNION ALL SELECT w.origin, w.rev + 1, 'branches/o' || CAST(o.o_orderkey AS VARCHAR), perms, rel, content
  FROM written w JOIN o ON o.origin = w.origin AND o.rev = w.rev + 1
  UNION ALL SELECT w.origin, w.rev + 2, 'old/o' || CAST(o.o_orderkey AS VARCHAR), perms, rel, content
  FROM written w JOIN o ON o.origin = w.origin AND o.rev = w.rev + 2)
SELECT origin, rev, dst || '/' || rel AS path, perms, {git_sha('blob', 'hex(content)')} AS blob_id FROM steps
"""

ORACLE_SQL["stream_visits"] = f"WITH {E_BASE} SELECT origin, rev, revision_id FROM chain"

ORACLE_SQL["altered_reload"] = f"""
WITH {V_BASE},
alt AS (SELECT h.origin, h.rev AS p FROM hc h WHERE NOT h.unaltered),
seed AS (SELECT a.origin, sha1('tampered ' || c.revision_id) AS parent
         FROM alt a JOIN chain c ON c.origin = a.origin AND c.rev = a.p),
m2 AS (SELECT m.* FROM meta m JOIN alt a ON a.origin = m.origin),
chain2 AS (
  SELECT * FROM (
    WITH RECURSIVE c(origin, rev, revision_id) AS (
      SELECT m.origin, m.rev, {git_sha('commit', "hex('tree ' || m.tree_id || chr(10) || 'parent ' || s.parent || chr(10) || 'author ' || m.who || chr(10) || 'committer ' || m.who || chr(10) || m.tail)")}
      FROM m2 m JOIN seed s ON s.origin = m.origin WHERE m.rev = 1
      UNION ALL
      SELECT m.origin, m.rev, {git_sha('commit', "hex('tree ' || m.tree_id || chr(10) || 'parent ' || c.revision_id || chr(10) || 'author ' || m.who || chr(10) || 'committer ' || m.who || chr(10) || m.tail)")}
      FROM m2 m JOIN c ON m.origin = c.origin AND m.rev = c.rev + 1)
    SELECT * FROM c))
SELECT origin, rev, revision_id FROM chain2
"""

ORACLE_SQL["append_new_objects"] = f"""
WITH {E_BASE},
mid AS (SELECT origin, max(rev) // 2 AS mid, max(rev) AS head FROM revs GROUP BY origin),
all_objects AS (
  SELECT 'content' AS object_type, blob_id AS id, f.rev <= m.mid AS early FROM fe f JOIN mid m ON m.origin = f.origin WHERE op = 'put'
  UNION ALL SELECT 'directory', tree_id, at_rev <= m.mid FROM dtid d JOIN mid m ON m.origin = d.origin
  UNION ALL SELECT 'directory', tree_id, rev <= m.mid FROM rtid t JOIN mid m ON m.origin = t.origin
  UNION ALL SELECT 'directory', {EMPTY}, true
  UNION ALL SELECT 'revision', revision_id, rev <= m.mid FROM chain c JOIN mid m ON m.origin = c.origin
  UNION ALL SELECT 'snapshot', 'first ' || origin, true FROM mid WHERE mid > 0
  UNION ALL SELECT 'snapshot', 'last ' || origin, false FROM mid WHERE head > mid
  UNION ALL SELECT 'visit', 'first ' || origin, true FROM mid WHERE mid > 0
  UNION ALL SELECT 'visit', 'last ' || origin, false FROM mid),
seen AS (SELECT object_type, id, bool_or(early) AS early FROM all_objects GROUP BY object_type, id)
SELECT object_type, CASE WHEN early THEN 'visit-1' ELSE 'visit-2' END AS visit, count(*) AS n FROM seen GROUP BY ALL
"""

ORACLE_SQL["archive_restore"] = f"""
WITH {E_LISTING},
sized AS (SELECT DISTINCT blob_id, CAST(strlen(data) AS BIGINT) AS length FROM (SELECT {git_sha('blob', 'hex(data)')} AS blob_id, data FROM ch WHERE op = 'put'))
SELECT l.origin, l.path, CASE WHEN kind = 'dir' THEN 16384 ELSE 33188 END AS perms, l.id, s.length
FROM lst l JOIN head h ON h.origin = l.origin AND l.at_rev = h.head LEFT JOIN sized s ON l.kind = 'file' AND s.blob_id = l.id
"""

ORACLE_SQL["apply_special"] = f"""
WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'link ' || lang || '/' || CAST(doc_id AS VARCHAR) ELSE text END AS data
  FROM documents),
e AS (SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN 40960 ELSE 33188 END AS perms,
             CASE WHEN doc_id % 8 = 0 THEN substr(data, 6) ELSE data END AS content FROM d)
SELECT doc_id, perms, {git_sha('blob', 'hex(content)')} AS sha1_git FROM e
"""

ORACLE_SQL["full_reload"] = f"""
WITH {E_BASE},
head AS (SELECT origin, max(rev) AS head_rev FROM revs GROUP BY origin)
SELECT h.origin, {git_sha('snapshot', "hex('revision HEAD') || '00' || hex('20:') || c.revision_id")} AS snapshot_id,
       'uneventful' AS load_status
FROM head h JOIN chain c ON c.origin = h.origin AND c.rev = h.head_rev
"""

ORACLE_SQL["scan_log"] = f"""
WITH {E_BASE}
SELECT c.origin, c.rev, c.event_type AS author, 'event ' || CAST(c.event_id AS VARCHAR) AS message, {STAMP.format(ts='c.ts')} AS date_text,
       CASE WHEN c.op = 'deldir' THEN c.dname ELSE c.dname || '/' || c.fname END AS path, CASE WHEN c.op = 'put' THEN 'put' ELSE 'delete' END AS action,
       true AS has_changes
FROM ch c
"""

ORACLE_SQL["scan_log_paths"] = f"""
WITH {E_BASE},
top AS (SELECT origin, arg_max(dname, rev) AS dname, arg_max(op, rev) AS op FROM ch GROUP BY origin),
hits AS (SELECT c.origin, c.rev, c.event_id, row_number() OVER (PARTITION BY c.origin ORDER BY c.rev) AS n
         FROM ch c JOIN top t ON t.origin = c.origin AND t.dname = c.dname)
SELECT origin, rev, 'event ' || CAST(event_id AS VARCHAR) AS message, CAST(NULL AS VARCHAR) AS path, false AS has_changes FROM hits WHERE n <= 10
"""

ORACLE_SQL["commit_info"] = f"""
WITH {V_BASE}
SELECT c.origin, c.rev, c.event_type AS author, 'event ' || CAST(c.event_id AS VARCHAR) AS message, {STAMP.format(ts='c.ts')} AS date_text
FROM ch c JOIN visits v ON v.origin = c.origin AND v.visit_rev = c.rev
"""

ORACLE_SQL["crawl_tree"] = f"""
WITH {E_EXPORT},
nodes AS (
  SELECT f.origin, f.dname || '/' || f.fname AS path, 'file' AS type FROM falive f JOIN head h ON h.origin = f.origin AND f.at_rev = h.head
  UNION ALL SELECT d.origin, d.dname, 'dir' FROM dalive d JOIN head h ON h.origin = d.origin AND d.at_rev = h.head
  UNION ALL SELECT origin, '', 'dir' FROM head),
held AS (SELECT p.origin, p.path, string_agg(p.name || '=' || p.value, chr(10) ORDER BY p.name) AS props FROM pst p JOIN head h ON h.origin = p.origin
         WHERE p.from_rev <= h.head AND (p.to_rev IS NULL OR h.head < p.to_rev) GROUP BY p.origin, p.path)
SELECT n.origin, n.path, n.type, coalesce(e.props, '') AS props FROM nodes n LEFT JOIN held e ON e.origin = n.origin AND e.path = n.path
"""

ORACLE_SQL["diff_stat"] = f"""
WITH {E_EXPORT},
puts AS (
  SELECT origin, rev, dname || '/' || fname AS path, data, lag(rev) OVER w AS prev_rev, lag(data) OVER w AS old FROM ch
  WHERE op = 'put' WINDOW w AS (PARTITION BY origin, dname, fname ORDER BY rev)),
follow AS (SELECT * FROM puts p WHERE old IS NOT NULL AND old <> data AND NOT EXISTS (
  SELECT 1 FROM kills k WHERE k.origin = p.origin AND k.path = p.path AND k.rev > p.prev_rev AND k.rev < p.rev)),
sides AS (
  SELECT origin, rev, path, unnest(string_split(data, chr(10))) AS line, 1 AS d FROM follow
  UNION ALL SELECT origin, rev, path, unnest(string_split(old, chr(10))), -1 FROM follow),
lines AS (SELECT origin, rev, path, line, sum(d) AS d FROM sides GROUP BY ALL)
SELECT origin, rev, path, CAST(coalesce(sum(d) FILTER (d > 0), 0) AS BIGINT) AS lines_added, CAST(coalesce(-sum(d) FILTER (d < 0), 0) AS BIGINT) AS lines_removed
FROM lines GROUP BY origin, rev, path
"""

ORACLE_SQL["visit_outcome"] = f"""
WITH {E_DUMPS},
{V_BASE[V_BASE.index("heads AS"):]},
per AS (SELECT origin, bool_and(complete) AS whole, max(rev) AS last, arg_max(no, start) AS last_no, arg_max(seen, start) AS last_seen FROM got GROUP BY origin),
m AS (SELECT *, CASE WHEN whole THEN last WHEN last_no = 0 AND NOT last_seen THEN last - 2 ELSE last - 1 END AS upto FROM per),
revd AS (SELECT origin, rev, bool_and(whole) AS whole FROM cuts GROUP BY origin, rev),
d AS (SELECT origin, max(rev) FILTER (whole) AS last_dumped, NOT bool_and(whole) AS short FROM revd GROUP BY origin),
asked AS (SELECT origin FROM revs UNION SELECT 'u' || CAST(CAST(substr(origin, 2) AS BIGINT) + 1 AS VARCHAR) FROM revs),
f AS (
  SELECT a.origin, p.start_rev, p.end_rev, d.origin IS NULL AS nf, p.start_rev > p.end_rev AS unev, CASE WHEN NOT m.whole THEN greatest(m.upto, 0) + 1 END AS fail_at,
         d.short AND coalesce(d.last_dumped, -1) <= p.last_loaded_rev AS err, CASE WHEN p.last_loaded_rev >= 0 THEN p.last_loaded_rev END AS prev
  FROM asked a LEFT JOIN plan p ON p.origin = a.origin LEFT JOIN m ON m.origin = a.origin LEFT JOIN d ON d.origin = a.origin),
g AS (SELECT *, coalesce(fail_at <= end_rev, false) AS fm,
             CASE WHEN fail_at <= end_rev THEN CASE WHEN fail_at - 1 >= start_rev THEN fail_at - 1 ELSE prev END END AS last_good FROM f)
SELECT origin,
       CASE WHEN nf OR unev THEN 'uneventful' WHEN err THEN 'failed' WHEN fm AND (last_good IS NULL OR last_good = prev) THEN 'uneventful' ELSE 'eventful' END AS load_status,
       CASE WHEN nf THEN 'not_found' WHEN unev THEN 'full' WHEN err THEN 'failed' WHEN fm THEN 'partial' ELSE 'full' END AS visit_status,
       CAST(CASE WHEN nf THEN NULL WHEN unev THEN prev WHEN err THEN NULL WHEN fm THEN last_good ELSE end_rev END AS BIGINT) AS snapshot_rev
FROM g
"""

ORACLE_SQL["build_snapshot_fallback"] = f"""
WITH {V_BASE},
goal AS (SELECT *, CASE WHEN start_rev > end_rev THEN last_loaded_rev ELSE head END AS at_rev FROM plan)
SELECT g.origin, {git_sha('snapshot', "hex('revision HEAD') || '00' || hex('20:') || c.revision_id")} AS snapshot_id, g.start_rev > g.end_rev AS reused
FROM goal g JOIN chain c ON c.origin = g.origin AND c.rev = g.at_rev
"""

ORACLE_SQL["normalize_changes"] = f"""
WITH {E_EXPORT},
{O_BASE.replace("revs AS (SELECT origin, rev FROM o)", "o_revs AS (SELECT origin, rev FROM o)").replace("j AS (", "oj AS (").replace("FROM j", "FROM oj")},
lined AS NOT MATERIALIZED (
  SELECT *, 'p' || CAST(l_partkey % 50 AS VARCHAR) AS top, 'p' || CAST(l_partkey % 50 AS VARCHAR) || '/' || l_returnflag AS dir,
         'p' || CAST(l_partkey % 50 AS VARCHAR) || '/' || l_returnflag || '/' || CAST(line AS VARCHAR) AS path FROM oj),
onward AS (
  SELECT o.origin, o.rev, 'branches/o' || CAST(o.o_orderkey AS VARCHAR) AS dst, c.dst || '@' || CAST(c.rev AS VARCHAR) AS detail FROM cp c JOIN o ON o.origin = c.origin AND o.rev = c.rev + 1
  UNION ALL
  SELECT o.origin, o.rev, 'old/o' || CAST(o.o_orderkey AS VARCHAR), 'branches/o' || CAST(b.o_orderkey AS VARCHAR) || '@' || CAST(b.rev AS VARCHAR)
  FROM cp c JOIN o b ON b.origin = c.origin AND b.rev = c.rev + 1 JOIN o ON o.origin = c.origin AND o.rev = c.rev + 2)
SELECT origin, rev, CASE WHEN op = 'put' THEN 2 ELSE 0 END AS seq, CASE WHEN op = 'deldir' THEN dname ELSE dname || '/' || fname END AS path,
       CASE WHEN op = 'deldir' THEN 'dir' ELSE 'file' END AS kind, CASE WHEN op = 'put' THEN 'put' ELSE 'delete' END AS event, CAST(NULL AS VARCHAR) AS detail FROM ch
UNION ALL SELECT origin, rev, 2, dname, 'dir', 'put', NULL FROM ch WHERE op = 'put'
UNION ALL SELECT origin, rev, 3, path, NULL, 'property', CASE WHEN value IS NULL THEN name ELSE name || '=' || value END FROM pe WHERE name IS NOT NULL
UNION ALL SELECT origin, rev, 2, path, 'file', 'put', NULL FROM lined
UNION ALL SELECT DISTINCT origin, rev, 2, dir, 'dir', 'put', NULL FROM lined
UNION ALL SELECT DISTINCT origin, rev, 2, top, 'dir', 'put', NULL FROM lined
UNION ALL SELECT origin, rev, 1, dst, 'dir', 'copy', src || '@' || CAST(rev - 1 AS VARCHAR) FROM cp
UNION ALL SELECT origin, rev, 1, dst, 'dir', 'copy', detail FROM onward
UNION ALL SELECT origin, rev, 3, path, NULL, 'property', 'svn:executable' || CASE WHEN l_suppkey % 4 = 0 THEN '=*' ELSE '' END FROM lined WHERE l_suppkey % 4 IN (0, 1)
UNION ALL SELECT origin, rev, 3, path, NULL, 'property', 'svn:special' || CASE WHEN line % 2 = 1 THEN '=*' ELSE '' END FROM lined WHERE l_partkey % 3 = 0
UNION ALL SELECT origin, rev, 3, path, NULL, 'property', 'svn:eol-style=' || ['native', 'LF', 'CRLF', 'CR', 'bogus'][CAST(l_suppkey % 5 AS INTEGER) + 1]
  FROM lined WHERE l_partkey % 3 = 1
UNION ALL SELECT origin, rev, 3, dst || '/' || flag || '/1', NULL, 'property', 'svn:executable' FROM cp, unnest(['A', 'N', 'R']) AS t(flag)
"""

ORACLE_SQL["origin_info"] = f"""
WITH {E_BASE},
heads AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin)
SELECT 'file:///repos/' || origin AS url, 'file:///repos/' || origin AS root_url, head AS head_rev, 1 AS initial_rev FROM heads
UNION ALL
SELECT 'file:///repos/' || d.origin || '/' || d.dname, 'file:///repos/' || d.origin, max(d.at_rev), 1 FROM dalive d GROUP BY d.origin, d.dname
"""

ORACLE_SQL["dump_plan"] = f"""
WITH {O_BASE},
heads AS (SELECT origin, max(rev) AS head FROM revs GROUP BY origin),
urls AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) AS origin, 'file:///repos/c' || CAST(c_custkey AS VARCHAR) AS root FROM customer),
found AS (
  SELECT u.*, h.head, EXISTS (SELECT 1 FROM puts p WHERE p.origin = u.origin AND starts_with(p.path, 'p4/')) AS has FROM urls u LEFT JOIN heads h ON h.origin = u.origin)
SELECT root || '/p4' AS url, CASE WHEN head IS NULL THEN root || '/p4' WHEN has THEN root END AS dump_url, CASE WHEN has THEN head END AS dump_max_rev,
       CASE WHEN head IS NULL THEN 'sub_path' WHEN has THEN 'whole' ELSE 'missing' END AS status
FROM found
"""

ORACLE_SQL["export_tree"] = f"""
WITH {E_EXPORT}
SELECT x.origin, x.dname || '/' || x.fname AS path, CASE x.mode WHEN '120000' THEN 40960 WHEN '100755' THEN 33261 ELSE 33188 END AS perms, x.id
FROM xi x JOIN head h ON h.origin = x.origin AND x.at_rev = h.head
UNION ALL SELECT t.origin, t.dname, 16384, t.tree_id FROM xt t JOIN head h ON h.origin = t.origin AND t.at_rev = h.head
"""

ORACLE_SQL["export_subpaths"] = f"""
WITH {E_EXPORT},
wanted AS (SELECT DISTINCT c.origin, CASE WHEN op = 'deldir' THEN dname ELSE dname || '/' || fname END AS path
           FROM ch c JOIN head h ON h.origin = c.origin WHERE c.rev > h.head - 3),
listing AS (
  SELECT x.origin, x.dname || '/' || x.fname AS path, CASE x.mode WHEN '120000' THEN 40960 WHEN '100755' THEN 33261 ELSE 33188 END AS perms, x.id
  FROM xi x JOIN head h ON h.origin = x.origin AND x.at_rev = h.head
  UNION ALL SELECT t.origin, t.dname, 16384, t.tree_id FROM xt t JOIN head h ON h.origin = t.origin AND t.at_rev = h.head),
chosen AS (SELECT DISTINCT l.origin, l.path FROM listing l JOIN wanted w ON w.origin = l.origin AND (l.path = w.path OR starts_with(l.path, w.path || '/')))
SELECT * FROM listing l WHERE EXISTS (SELECT 1 FROM chosen c WHERE c.origin = l.origin AND (c.path = l.path OR starts_with(c.path, l.path || '/')))
"""

ORACLE_SQL["tree_diff"] = f"""
WITH {E_LISTING},
n AS (SELECT *, at_rev AS rev FROM lst),
o AS (SELECT l.*, l.at_rev + 1 AS rev FROM lst l JOIN head h ON h.origin = l.origin AND l.at_rev < h.head)
SELECT coalesce(n.origin, o.origin) AS origin, coalesce(n.rev, o.rev) AS rev, coalesce(n.path, o.path) AS path, coalesce(n.kind, o.kind) AS kind,
       CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS status
FROM n FULL OUTER JOIN o ON n.origin = o.origin AND n.rev = o.rev AND n.path = o.path
WHERE n.id IS DISTINCT FROM o.id
"""

ORACLE_SQL["collect_objects"] = f"""
WITH {E_BASE},
firsts AS (
  SELECT f.origin, CASE WHEN strlen(c.data) > 12 THEN 's' ELSE 'c' END AS kind, f.blob_id AS id, min(f.rev) AS rev
  FROM fe f JOIN ch c ON c.origin = f.origin AND c.rev = f.rev WHERE f.op = 'put' GROUP BY ALL
  UNION ALL
  SELECT origin, 'd', tree_id, min(at_rev) FROM (SELECT origin, at_rev, tree_id FROM dtid UNION ALL SELECT origin, rev, tree_id FROM rtid) GROUP BY origin, tree_id)
SELECT origin, rev, count(*) FILTER (kind = 'c') AS contents, count(*) FILTER (kind = 's') AS skipped, count(*) FILTER (kind = 'd') AS directories
FROM firsts GROUP BY origin, rev
"""

ORACLE_SQL["batch_limits"] = f"""
WITH {E_BASE},
firsts AS (SELECT f.origin, f.blob_id, min(f.rev) AS rev, min(strlen(c.data)) AS length FROM fe f JOIN ch c ON c.origin = f.origin AND c.rev = f.rev
           WHERE f.op = 'put' GROUP BY f.origin, f.blob_id),
numbered AS (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY rev, blob_id) AS n FROM firsts),
folded AS (
  SELECT * FROM (
    WITH RECURSIVE b(origin, n, flush, held, bytes) AS (
      SELECT origin, n, CAST(1 AS BIGINT), CAST(1 AS BIGINT), CAST(length AS BIGINT) FROM numbered WHERE n = 1
      UNION ALL
      SELECT x.origin, x.n, CASE WHEN b.held >= 10 OR b.bytes >= 120 THEN b.flush + 1 ELSE b.flush END,
             CASE WHEN b.held >= 10 OR b.bytes >= 120 THEN 1 ELSE b.held + 1 END,
             CASE WHEN b.held >= 10 OR b.bytes >= 120 THEN x.length ELSE b.bytes + x.length END
      FROM b JOIN numbered x ON x.origin = b.origin AND x.n = b.n + 1)
    SELECT * FROM b))
SELECT x.origin, x.rev, x.blob_id, b.flush FROM folded b JOIN numbered x ON x.origin = b.origin AND x.n = b.n
"""

ORACLE_SQL["propget"] = f"""
WITH {E_PROPS},
{V_BASE[V_BASE.index("heads AS"):]},
asked AS (
  SELECT DISTINCT v.origin, v.visit_rev AS rev, c.dname AS target, 'svn:eol-style' AS name FROM visits v JOIN ch c ON c.origin = v.origin AND c.op = 'put'
  UNION ALL SELECT origin, head, '', 'svn:executable' FROM head)
SELECT a.origin, a.rev, a.target, a.name, p.path, p.value
FROM asked a JOIN pst p ON p.origin = a.origin AND p.name = a.name AND p.from_rev <= a.rev AND (p.to_rev IS NULL OR a.rev < p.to_rev)
  AND (a.target = '' OR starts_with(p.path, a.target || '/'))
"""

ORACLE_SQL["gap_buffer"] = f"""
WITH {E_BASE}
SELECT origin, rev, CAST(event_id AS VARCHAR) AS payload, false AS late, max(event_id % 4) OVER (PARTITION BY origin ORDER BY rev) AS batch FROM ev
"""

ORACLE_SQL["write_extids"] = f"""
WITH {E_LISTING},
named AS (SELECT l.origin, l.path, string_split(l.path, '/')[1] AS top, sha256(CASE WHEN kind = 'dir' THEN '40000' ELSE '100644' END || ' ' || l.id || ' ' || l.path) AS digest
          FROM lst l JOIN head h ON h.origin = l.origin AND l.at_rev = h.head),
tops AS (SELECT origin, top, sha256(string_agg(digest, '' ORDER BY path)) AS digest FROM named GROUP BY origin, top),
sums AS (SELECT origin, sha256(string_agg(digest, '' ORDER BY top)) AS checksum FROM tops GROUP BY origin)
SELECT DISTINCT t.tree_id AS id, 'sha256-manifest' AS checksum_layout, s.checksum FROM sums s JOIN head h ON h.origin = s.origin
JOIN rtid t ON t.origin = h.origin AND t.rev = h.head
"""

ORACLE_SQL["write_visit"] = f"""
WITH outcome AS ({ORACLE_SQL["visit_outcome"].replace("WITH ", "WITH ", 1)}),
{E_BASE}
SELECT o.origin, 'svn' AS visit_type, o.visit_status AS status,
       CASE WHEN o.snapshot_rev IS NOT NULL THEN
         {git_sha('snapshot', "hex('revision HEAD') || '00' || hex('20:') || c.revision_id")} END AS snapshot_id
FROM outcome o LEFT JOIN chain c ON c.origin = o.origin AND c.rev = o.snapshot_rev
"""

ORACLE_SQL["stream_visits_export"] = f"""
WITH {E_EXPORT},
signed AS (SELECT m.origin, m.rev, {git_sha('tree', 'x.body')} AS tree_id, m.who, m.tail FROM meta m JOIN xr x ON x.origin = m.origin AND x.rev = m.rev)
{_chain('signed')}
"""
