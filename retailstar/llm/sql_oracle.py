r"""DuckDB SQL for the operators that SQL can express: plain definitions, by
enumerating all windows and all pairs that share an n-gram."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def substring_dedup(window: int = 35) -> str:
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
starts AS (SELECT r, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM w WHERE len(ws) >= {window}),
named AS (SELECT r, i, md5(array_to_string(ws[i:i + {window - 1}], ' ')) AS h FROM starts),
again AS (SELECT r, i FROM named WHERE h IN (SELECT h FROM named GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + k AS j FROM again, range(0, {window}) AS t(k)),
each AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
kept AS (
  SELECT e.r, string_agg(CASE WHEN g.j IS NULL THEN e.word END, ' ' ORDER BY e.j) AS t, count(g.j) AS n_removed
  FROM each e LEFT JOIN gone g ON e.r = g.r AND e.j = g.j GROUP BY e.r)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.r = k.r"""


def ngram_join(shingle: int = 3, percent: int = 90) -> str:
    return f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
sets AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + {shingle - 1}], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {shingle - 2})) AS i FROM w WHERE len(ws) >= {shingle})
  UNION ALL
  SELECT r, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND {shingle - 1}),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
shared AS (
  SELECT a.r AS x, b.r AS y, count(*) AS o FROM sets a JOIN sets b ON a.s = b.s AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON x = p.r JOIN sizes q ON y = q.r
  WHERE 100 * o >= {percent} * (p.n + q.n - o)),
reach(x, y) AS (
  SELECT r, r FROM w
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN w ON reach.y = w.r GROUP BY x)
SELECT w.doc_id, coalesce(sizes.n, 0) AS n_shingles, least.component_id
FROM w JOIN least ON w.r = least.x LEFT JOIN sizes ON w.r = sizes.r"""


_INTEGERS = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def hard_negatives(most: int = 5, low: int = 80) -> str:
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         {_INTEGERS} AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {most}),
ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
   AND {low} * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {most}"""


def centroid_clustering(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    near = """
a{i} AS (
  SELECT v.r, v.vec_id, arg_min(c.n, struct_pack(d := list_inner_product(list_transform(range(1, len(v.x) + 1),
           lambda i: v.x[i] - c.x[i]), list_transform(range(1, len(v.x) + 1), lambda i: v.x[i] - c.x[i])), n := c.n)) AS c,
         min(list_inner_product(list_transform(range(1, len(v.x) + 1), lambda i: v.x[i] - c.x[i]),
             list_transform(range(1, len(v.x) + 1), lambda i: v.x[i] - c.x[i]))) AS d
  FROM v, c{i} c GROUP BY v.r, v.vec_id),"""
    move = f"""
s{{i}} AS (
  SELECT c, place, floor(sum(x) / count(*)) AS x FROM (
    SELECT a.c, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS place FROM a{{i}} a JOIN v ON a.r = v.r)
  GROUP BY c, place),
c{{j}} AS (
  SELECT o.n, coalesce(m.x, o.x) AS x FROM c{{i}} o
  LEFT JOIN (SELECT c, list(x ORDER BY place) AS x FROM s{{i}} GROUP BY c) m ON o.n = m.c),"""
    steps = "".join(near.format(i=i) + move.format(i=i, j=i + 1) for i in range(rounds)) + near.format(i=rounds)
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, {_INTEGERS} AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND {_FINITE}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS n, x FROM (
    SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, x FROM v ORDER BY h, x LIMIT {k})),{steps}
digest AS (
  SELECT n, sha256(array_to_string(list_transform(x, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
  FROM c{rounds})
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} a JOIN digest ON digest.n = a.c"""


def warc() -> str:
    # base32 of the digest: five hex digits are four characters
    group = "CAST('0x' || substr(h, 1 + 5 * g, 5) AS INTEGER)"
    letters = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({group} >> {k}) & 31), 1)" for k in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS t FROM pages),
named AS (
  SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS top,
         row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST, r) AS k
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(8), lambda g: {letters}), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN top END AS refers_to
FROM named"""


ORACLE_SQL = {
    "op3_substring_dedup": substring_dedup(),
    "op10_ngram_join": ngram_join(),
    "op11_warc": warc(),
    "op12_hard_negatives": hard_negatives(),
    "op13_centroid_clustering": centroid_clustering(),
}
