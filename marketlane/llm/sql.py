"""DuckDB SQL for the operators that it can express."""

from __future__ import annotations

from marketlane.llm.url_trust import ADDRESS, DAMPING, RATIO, RULES

#: Neighbours by brute force, in the same double precision.
NEAREST = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: Hard negatives by brute force over whole components.
HARD_NEGATIVES = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) <= 3
"""

#: One table step of crc32 for each byte value.
_CRC_TABLE = """
crc0 AS (SELECT CAST(range AS UBIGINT) AS b, CAST(range AS UBIGINT) AS c FROM range(256)),
"""


def _crc_table() -> str:
    steps = [_CRC_TABLE.strip()]
    for k in range(8):
        steps.append(
            f"crc{k + 1} AS (SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END AS c FROM crc{k}),"
        )
    return "\n".join(steps)


#: Exact places by running sums over the whole table, in the operator's order.
SHARDS = f"""
WITH {_crc_table()}
crc AS (SELECT list(c ORDER BY b) AS t FROM crc8),
d AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size FROM documents
), bytes AS (
  SELECT doc_id, text, size, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS UBIGINT)) AS b FROM d
), sums AS (
  SELECT doc_id, size, md5(text) AS digest,
    CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, b),
      lambda a, x: xor(a >> 8, t[CAST(xor(a, x) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32
  FROM bytes, crc
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM sums
), sharded AS (
  SELECT *, CAST(least(15, ((2 * upto - size) * 16) // (2 * total)) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""


#: Rounds after which no score of the walk moves by a ten-thousandth of itself (0.85 ** 60), and farthest host in steps.
ROUNDS = 60


def _url_verdicts() -> str:
    rules = ", ".join(f"('{r.text}', '{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    steps = []
    for k in range(1, ROUNDS + 1):
        steps.append(f"""s{k} AS MATERIALIZED (
  SELECT kind, node, sum(part) AS score FROM (
    SELECT e.kind, e.dst AS node, s.score * e.share * {DAMPING} AS part FROM s{k - 1} s JOIN e ON s.kind = e.kind AND s.node = e.src
    UNION ALL SELECT kind, node, mass * (1 - {DAMPING}) FROM seeds
  ) GROUP BY ALL
)""")
    return f"""
WITH rules(rule, rhost, rpath, rverdict) AS (VALUES {rules}),
u AS (
  SELECT row_number() OVER () AS n, page_id, html,
    CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT n, page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u
), fits AS (
  SELECT n, rule, rverdict, row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC) AS k
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
), j AS (
  SELECT h.*, f.rule, f.rverdict FROM h LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (n)
), counts AS (
  SELECT CASE rverdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, CAST(count(*) AS DOUBLE) AS pages
  FROM j WHERE rverdict IS NOT NULL AND host <> '' GROUP BY ALL
), seeds AS MATERIALIZED (
  SELECT kind, host AS node, pages / sum(pages) OVER (PARTITION BY kind) AS mass FROM counts
), raw AS (
  SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s>]+)', 1)) AS d FROM h
), links AS (
  SELECT src, translate(d, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst, 1.0::DOUBLE AS links FROM raw
), kept AS (SELECT * FROM links WHERE src <> '' AND dst <> '' AND src <> dst),
hosts AS (SELECT DISTINCT host FROM (SELECT host FROM h UNION ALL SELECT src FROM kept UNION ALL SELECT dst FROM kept) WHERE host <> ''),
labels_of AS (SELECT string_split(host, '.') AS l FROM hosts WHERE NOT regexp_matches(host, '{ADDRESS}')),
ups AS (
  SELECT DISTINCT array_to_string(l[k:], '.') AS a, array_to_string(l[k + 1:], '.') AS b
  FROM (SELECT l, unnest(range(1, len(l) - 1)) AS k FROM labels_of WHERE len(l) > 2)
), steps AS (
  SELECT * FROM kept UNION ALL SELECT a, b, 1.0 FROM ups WHERE a <> '' AND b <> '' AND a <> b
  UNION ALL SELECT b, a, 1.0 FROM ups WHERE a <> '' AND b <> '' AND a <> b
), pairs AS (SELECT src, dst, sum(links) AS links FROM steps GROUP BY ALL),
both_ways AS (SELECT 'trust' AS kind, src, dst, links FROM pairs UNION ALL SELECT 'distrust', dst, src, links FROM pairs),
e AS MATERIALIZED (SELECT kind, src, dst, links / sum(links) OVER (PARTITION BY kind, src) AS share FROM both_ways),
s0 AS (SELECT kind, node, mass * (1 - {DAMPING}) AS score FROM seeds),
{", ".join(steps)},
bad AS (
  SELECT node AS host FROM s{ROUNDS} GROUP BY node
  HAVING coalesce(sum(CASE WHEN kind = 'distrust' THEN score END), 0) > {RATIO} * coalesce(sum(CASE WHEN kind = 'trust' THEN score END), 0)
)
SELECT page_id, host, path, rule, coalesce(rverdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""


CHECKS = {
    "op5_url_filters": _url_verdicts(),
    "op6_sharding": SHARDS,
    "op10_nearest_neighbours": NEAREST,
    "op13_hard_negatives": HARD_NEGATIVES,
}
