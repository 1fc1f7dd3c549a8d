"""DuckDB SQL of the queries that SQL can express.

The others depend on a tokenizer's merges, a trained model, signature rules or
hash fingerprints; tests/llm compares them with brute force.
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WARC = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS last_id
  FROM pages)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last_id THEN NULL ELSE last_id END::DOUBLE AS refers_to  -- as pandas holds a nullable long
FROM hashed
"""

NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT a, b FROM both_ways
  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
least AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.c, d.doc_id) AS component_id,
       coalesce(l.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
"""

_ALNUM = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (
  SELECT DISTINCT item_id, w, least(10, len(w))::BIGINT AS n
  FROM (SELECT item_id, {_ALNUM} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2),
    lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM items),
docs AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM docs JOIN (SELECT DISTINCT n FROM windows) k ON len(w) >= n),
hits AS (SELECT p.doc_id, p.pos, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.g = p.g),
hit_words AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN hit_items i ON i.doc_id = d.doc_id
"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT d.doc_id, u.k, u.line, translate(trim(u.line, {_SPACES}),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       LATERAL (SELECT unnest(l) AS line, unnest(range(len(l))) AS k) u),
shared AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT l.*, s.key IS NOT NULL AND l.doc_id <> s.last AS dropped
  FROM lines l LEFT JOIN shared s ON s.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def merkle_sql(levels: int = 5, tops: int = 3) -> str:
    """The manifest of up to 16**levels rows a source and 16**tops sources."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda x: ord(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), "
           f"lambda c, j: {step})), 4294967295)")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""leaves AS (
  SELECT doc_id, source, {leaf("text")} AS d, CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS t
  FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS r,
  coalesce(source, '') AS s0, source IS NOT NULL AS s1 FROM leaves),
n0 AS (SELECT s1, s0, r, d, count(*) OVER (PARTITION BY s1, s0) AS n FROM ranked)"""]
    for name, depth, by in (("n", levels, "s1, s0"), ("m", tops, "z")):
        if name == "m":
            parts.append(f"subs AS (SELECT s1, s0, d, row_number() OVER (ORDER BY s1, s0) - 1 AS r FROM n{levels} WHERE r = 0)")
            parts.append("m0 AS (SELECT 0 AS z, r, d, count(*) OVER () AS n FROM subs)")
        for k in range(depth):
            parts.append(f"{name}g{k} AS (SELECT {by}, r // 16 AS r, any_value(n) AS n, list(d ORDER BY r) AS ds "
                         f"FROM {name}{k} GROUP BY {by}, r // 16)")
            parts.append(f"{name}{k + 1} AS (SELECT {by}, r, CASE WHEN n = 1 THEN 1 ELSE (n + 15) // 16 END AS n, "
                         f"CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d FROM {name}g{k})")
    parts.append("w0 AS (SELECT x.*, u.d AS subroot, u.r AS top, 0 AS z FROM "
                 "(SELECT doc_id, s1, s0, r, d AS leaf, t AS f, '' AS p FROM ranked) x "
                 "JOIN subs u ON u.s1 = x.s1 AND u.s0 = x.s0)")
    now = 0
    for name, depth, on in (("n", levels, "g.s1 = w.s1 AND g.s0 = w.s0"), ("m", tops, "g.z = w.z")):
        at = "r" if name == "n" else "top"
        for k in range(depth):
            left, right = f"array_to_string(g.ds[:w.{at} % 16], '')", f"array_to_string(g.ds[w.{at} % 16 + 2:], '')"
            parts.append(f"w{now + 1} AS (SELECT w.* REPLACE (w.{at} // 16 AS {at}, "
                         f"CASE WHEN g.n = 1 THEN w.f ELSE sha256({left} || w.f || {right}) END AS f, "
                         f"CASE WHEN g.n = 1 THEN w.p ELSE w.p || {left} || {right} END AS p) "
                         f"FROM w{now} w JOIN {name}g{k} g ON {on} AND g.r = w.{at} // 16)")
            now += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT w.doc_id, w.leaf, w.subroot, m.d AS root, sha256(w.p) AS proof_sha256, w.f AS folded_root, w.f = m.d AS verified
FROM w{now} w, m{tops} m
"""


ORACLE_SQL = {
    "op5_warc_index": WARC,
    "op7_chosen_path": NEAR,
    "op8_decontamination": DECONTAMINATION,
    "op11_line_dedup": LINE_DEDUP,
    "op13_merkle_manifest": merkle_sql(),
}
