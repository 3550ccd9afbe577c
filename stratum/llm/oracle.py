"""SQL (DuckDB dialect) for the queries that it can express, written from their contracts."""

from __future__ import annotations

_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLE: dict[str, str] = {}

ORACLE["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_WORD}) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), {_WORD}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
    unnest([array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ')
            for k in range(1, len(w) - least(10, len(w)) + 2)]) AS win
  FROM i WHERE len(w) > 0),
places AS (
  SELECT doc_id, n, unnest([{{'pos': k, 'win': array_to_string(list_slice(w, k, k + n - 1), ' ')}}
                            for k in range(1, len(w) - n + 2)]) AS p
  FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, p.pos AS pos, places.n AS n, item_id FROM places
         JOIN windows ON windows.n = places.n AND windows.win = places.p.win),
words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits)
          GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

ORACLE["op4_url_filter"] = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_UPPER}), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (
        PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN m ON m.page_id = h.page_id AND place = 1"""

ORACLE["op5_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[\x20\x09-\x0D]+') if x <> ''] AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] for k in range(1, len(w) - 1)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
           GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT a AS doc_id, b AS other FROM links
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
least_of AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(other, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least_of l ON l.doc_id = w.doc_id"""

ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest,
        CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS response FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN response <> page_id THEN response END AS refers_to
FROM q"""


def _cells(scale: int) -> str:
    """Kept vectors of 64 finite components as rows (r, i, v), r numbering the vectors by id."""
    return f"""
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = 64),
cells AS MATERIALIZED (SELECT r, i, CAST(floor(embedding[i] * CAST({scale} AS DOUBLE)) AS BIGINT) AS v
  FROM kept, (SELECT unnest(range(1, 65)) AS i))"""


_FLOORED = "(s - ((s % n) + n) % n) // n"


def _orchard(rounds: int = 6, entries: int = 16) -> str:
    parts = [f"""WITH {_cells(4096)},
x AS MATERIALIZED (SELECT r, (i - 1) // 8 AS p, i, v FROM cells),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, i, v FROM x WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := d, e := e)) AS best FROM (
  SELECT x.r, x.p, e, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{k} c ON c.p = x.p AND c.i = x.i
  GROUP BY x.r, x.p, e) GROUP BY r, p)""")
        if k < rounds:
            parts.append(f"""m{k} AS (SELECT x.p, best.e AS e, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{k} a
  ON a.r = x.r AND a.p = x.p GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, c.i, CASE WHEN n IS NULL THEN v ELSE {_FLOORED} END AS v FROM c{k} c LEFT JOIN m{k} m
  ON m.p = c.p AND m.e = c.e AND m.i = c.i)""")
    parts.append(f"""rows AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}) AS codebooks_sha256
FROM rows JOIN kept USING (r)""")
    return ",\n".join(parts[:-1]) + ",\n" + parts[-1]


def _kmeans(rounds: int = 10, centroids: int = 8) -> str:
    parts = [f"""WITH {_cells(1024)},
seeds AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, r) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, i, v FROM cells JOIN seeds USING (r) WHERE c < {centroids})"""]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, c := c)) AS best FROM (
  SELECT x.r, c.c, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM cells x JOIN c{k} c ON c.i = x.i GROUP BY x.r, c.c) GROUP BY r)""")
        if k < rounds:
            parts.append(f"""m{k} AS (SELECT best.c AS c, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n FROM cells JOIN a{k} USING (r) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.c, c.i, CASE WHEN n IS NULL THEN v ELSE {_FLOORED} END AS v FROM c{k} c LEFT JOIN m{k} m
  ON m.c = c.c AND m.i = c.i)""")
    parts.append(f"""sha AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN sha ON sha.c = best.c""")
    return ",\n".join(parts[:-1]) + ",\n" + parts[-1]


ORACLE["op11_orchard_codes"] = _orchard()
ORACLE["op12_ns_kmeans"] = _kmeans()
ORACLE["op13_reply_trees"] = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
  VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
  coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
f AS (SELECT *, regexp_replace(text, '(<<?/?|\[/?)(\\*)(s>|SYS>>|INST\]|ROLE\])', '\1\\\2\3', 'g') AS body,
  regexp_replace(role, '(<<?/?|\[/?)(\\*)(s>|SYS>>|INST\]|ROLE\])', '\1\\\2\3', 'g') AS head FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(body) + CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 10 WHEN 'system' THEN 18
    ELSE 17 + length(replace(replace(head, '~', '~0'), chr(10), '~1')) END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""
