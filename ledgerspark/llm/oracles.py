"""SQL for the queries that SQL can express, over the given tables."""

from __future__ import annotations

from ledgerspark.llm.urls import ASIDE, COUNTS, ORDER, RULES, START, STEP, UNIT

TOP_K = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE)))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(q.x, d.x) AS BIGINT) AS score
  FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT conv_id, turn, r, x,
         length(regexp_replace(replace(replace(r, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g'))
         + length(regexp_replace(x, '<(\\*)\|', '<\\\1|', 'g')) + 24 AS shown
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
w AS (SELECT page_id, n, digest, max(page_id) OVER (PARTITION BY digest, n) AS writer FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < writer THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < writer THEN writer END AS refers_to, true AS valid
FROM w
"""


def _rules() -> str:
    """Fitting rules, the longest first."""
    fits = [f"WHEN (host = '{own}' OR host LIKE '%.{own}') AND starts_with(path, '{start}') THEN '{own}{start}|{verdict}'"
            for verdict, own, start in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r))]
    return "CASE " + " ".join(fits) + " END"


def _levels() -> str:
    """The models of 0 to ORDER signs of context, each from the one before."""
    parts = []
    for k in range(ORDER + 1):
        sums = ", ".join(f"CAST(sum({v}) AS BIGINT) AS {v}" for v in COUNTS)
        seen = ", ".join(f"CAST(sum({v}) OVER c AS BIGINT) AS {v}_n, count(*) FILTER (WHERE {v} > 0) OVER c AS {v}_k" for v in COUNTS)
        before = {v: f"s.{v}_p" if k else "CAST(1 AS DOUBLE) / (l.signs + 1)" for v in COUNTS}
        blends = ", ".join(f"CASE WHEN {v}_n > 0 THEN ({v} + {v}_k * {before[v]}) / ({v}_n + {v}_k) ELSE {before[v]} END AS {v}_p" for v in COUNTS)
        shorter = f" JOIN p{k - 1} AS s ON s.gram = substr(l.gram, 2)" if k else ""
        parts += [f"n{k} AS (SELECT right(gram, {k + 1}) AS gram, {sums} FROM n GROUP BY 1),",
                  f"l{k} AS (SELECT *, {seen}, count(*) OVER c AS signs FROM n{k} WINDOW c AS (PARTITION BY left(gram, {k}))),",
                  f"p{k} AS (SELECT l.gram AS gram, {blends} FROM l{k} AS l{shorter}),"]
    return "\n".join(parts)


_BOTH = ("allow", "block")
URLS = f"""
WITH o AS (
  SELECT row_number() OVER () AS row_id, page_id, url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT row_id, page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM o),
f AS (SELECT row_id, page_id, url, host, path, {_rules()} AS hit FROM h),
d AS (SELECT row_id, page_id, host, path, split_part(hit, '|', 1) AS rule, CASE WHEN hit IS NOT NULL THEN split_part(hit, '|', 2) END AS verdict,
             coalesce(md5(url) < '{ASIDE}', false) AS aside, coalesce(url, '') AS url FROM f),
g AS (SELECT row_id, verdict, aside, substr('{START * ORDER}' || url, i, {ORDER + 1}) AS gram
      FROM (SELECT row_id, verdict, aside, url, unnest(range(1, length(url) + 1)) AS i FROM d)),
n AS (SELECT gram, {', '.join(f"CAST(count(*) FILTER (WHERE verdict = '{v}') AS BIGINT) AS {v}, CAST(count(*) FILTER (WHERE verdict = '{v}' AND NOT aside) AS BIGINT) AS {v}_part" for v in _BOTH)} FROM g GROUP BY gram),
{_levels()}
m AS (SELECT gram, {', '.join(f"CAST(round((ln(allow{e}_p) - ln(block{e}_p)) * {UNIT}) AS BIGINT) AS ratio{e}" for e in ('', '_part'))} FROM p{ORDER}),
b AS (SELECT g.row_id AS row_id, {', '.join(f"CAST(floor(CAST(sum(ratio{e}) AS DOUBLE) / count(*) / {STEP}) AS BIGINT) AS bin{e}" for e in ('', '_part'))} FROM g JOIN m ON m.gram = g.gram GROUP BY g.row_id),
j AS (SELECT page_id, host, path, rule, verdict, aside, coalesce(bin, 0) AS bin, coalesce(bin_part, 0) AS bin_part FROM d LEFT JOIN b ON b.row_id = d.row_id),
q AS (SELECT bin_part AS bin, count(*) FILTER (WHERE verdict = 'allow') AS allow, count(*) FILTER (WHERE verdict = 'block') AS block FROM j WHERE verdict IS NOT NULL AND aside GROUP BY bin_part),
z AS (SELECT least(bin, greatest(0, lag(bin) OVER (ORDER BY bin) + 1)) AS cut, CAST(coalesce(sum(allow) OVER u, 0) AS DOUBLE) / nullif(sum(allow) OVER (), 0) + (1 - CAST(coalesce(sum(block) OVER u, 0) AS DOUBLE) / nullif(sum(block) OVER (), 0)) AS wrong
      FROM q WINDOW u AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT coalesce((SELECT cut FROM z WHERE wrong IS NOT NULL ORDER BY wrong, abs(cut), cut LIMIT 1), 0) AS least)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bin >= least THEN 'allow' ELSE 'block' END) AS verdict FROM j, t
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, min({'label': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END, 'x': list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE)))}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
  GROUP BY vec_id),
s AS (
  SELECT a.vec_id AS anchor_id, d.vec_id AS vec_id, a.r.label = d.r.label AS same, CAST(list_dot_product(a.r.x, d.r.x) AS BIGINT) AS score
  FROM v AS a JOIN v AS d ON a.vec_id <> d.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
w AS (
  SELECT p.anchor_id AS anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE place <= 5
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)),
o AS (
  SELECT lang, unnest(ws) AS phrase, 1 AS words FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM p
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM p),
f AS MATERIALIZED (SELECT lang, phrase, words, concat_ws('|', lang, phrase) AS key, count(*) AS f FROM o GROUP BY lang, phrase, words),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
g AS MATERIALIZED (SELECT * FROM f WHERE f >= 10),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM g WHERE words > 1),
u AS (SELECT lang, phrase, words, a, w, unnest(range(1, words)) AS cut FROM c),
k AS MATERIALIZED (SELECT lang, phrase, a, cut, concat_ws('|', lang, array_to_string(w[1:cut], ' ')) AS before, concat_ws('|', lang, array_to_string(w[cut + 1:], ' ')) AS after FROM u),
m AS MATERIALIZED (SELECT k.*, g.f AS l FROM k JOIN g ON g.key = k.before),
s AS (SELECT m.lang AS lang, m.phrase AS phrase, a, cut, l, g.f AS r, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * g.f) AS BIGINT) AS score FROM m JOIN g ON g.key = m.after),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (
  SELECT lang, phrase, max(a) AS around FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE words = 3) GROUP BY lang, phrase),
z AS (
  SELECT b.lang AS lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS place, b.phrase AS phrase, a, l, r, score
  FROM b LEFT JOIN d ON d.lang = b.lang AND d.phrase = b.phrase WHERE around IS NULL OR 100 * around < 50 * a)
SELECT z.lang AS lang, CAST(place AS INTEGER) AS rank, phrase, a, l, r, n, score FROM z JOIN n ON n.lang = z.lang WHERE place <= 2000
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT a AS node, a AS reached FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT node, min(reached) AS least FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id AS vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.least, e.vec_id) AS component_id, coalesce(c.least, e.vec_id) IS NOT DISTINCT FROM e.vec_id AS kept
FROM embeddings AS e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.node = e.vec_id
"""

ORACLES = {
    "op1_topk": TOP_K, "op2_chat": CHAT, "op4_url_filter": URLS, "op6_warc": WARC,
    "op11_hard_negatives": HARD_NEGATIVES, "op12_collocations": COLLOCATIONS, "op13_embedding_dedup": NEAR_VECTORS,
}
