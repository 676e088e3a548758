"""DuckDB SQL of the operators that SQL can express."""

OP1_MIXING = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w FROM s
), lines AS (
  SELECT (SELECT sum(source_size) FROM r) AS words, 0 AS capped, sum(w) AS free FROM r
  UNION ALL
  SELECT (SELECT sum(source_size) FROM r),
         (SELECT coalesce(sum(3 * q.source_size), 0) FROM r q WHERE q.source_size * p.w <= p.source_size * q.w),
         (SELECT sum(q.w) FROM r q WHERE q.source_size * p.w > p.source_size * q.w)
  FROM r p
), level AS (
  SELECT max((words::DOUBLE - capped::DOUBLE) / free::DOUBLE) AS water FROM lines WHERE free > 0
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, w * water) AS target FROM r, level
), p AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size), 3)::BIGINT END AS passes FROM t
), c AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS tied
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN upto - tied / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

def _step(k: int) -> str:
    """Estimates of the windows' last characters after contexts of up to k - 1 characters."""
    mixed = ", ".join(f"CASE WHEN c.{x}n > 0 THEN (coalesce(g.{x}, 0)::DOUBLE + c.{x}t::DOUBLE * p.p{x}) / (c.{x}n + c.{x}t)::DOUBLE "
                      f"ELSE p.p{x} END AS p{x}" for x in "ar")
    return f"""p{k} AS (
  SELECT p.win, {mixed} FROM p{k - 1} p
  LEFT JOIN grams g ON g.gram = substr(p.win, {6 - k}, {k}) LEFT JOIN contexts c ON c.context = substr(p.win, {6 - k}, {k - 1})
)"""


# Character models: every window of five characters (padded), its suffixes' counts in both classes, Witten-Bell
# estimates from the shortest context up, log ratios in whole billionths summed per address, and the threshold
# with the best balanced accuracy on the addresses kept out.
OP2_URL_FILTER = r"""
WITH parsed AS (
  SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages
), judged AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed
), rules AS (
  SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) t(host, path, verdict)
), fitting AS (
  SELECT j.host, j.path, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM judged) j
  JOIN rules r ON (j.host = r.host OR ends_with(j.host, '.' || r.host)) AND starts_with(j.path, r.path) GROUP BY 1, 2
), ruled AS (
  SELECT j.*, j.host || j.path AS address, f.rule, f.verdict FROM judged j LEFT JOIN fitting f ON f.host = j.host AND f.path = j.path
), addresses AS (
  SELECT address, max(verdict) = 'allow' AS accepted, ('0x' || substr(md5(address), 1, 8))::BIGINT % 5 = 0 AS held,
         repeat(chr(2), 4) || address || chr(3) AS padded
  FROM ruled GROUP BY address
), places AS (
  SELECT address, accepted, held, substr(padded, i, 5) AS win
  FROM (SELECT *, unnest(range(1, length(address) + 2)) AS i FROM addresses)
), whole AS (
  SELECT win, count(*) FILTER (WHERE accepted) AS a, count(*) FILTER (WHERE NOT accepted) AS r
  FROM places WHERE accepted IS NOT NULL AND NOT held GROUP BY win
), grams AS (
  SELECT substr(win, 6 - k, k) AS gram, substr(win, 6 - k, k - 1) AS context, sum(a) AS a, sum(r) AS r
  FROM whole, range(1, 6) t(k) GROUP BY 1, 2
), contexts AS (
  SELECT context, sum(a) AS an, sum(r) AS rn, count(*) FILTER (WHERE a > 0) AS at, count(*) FILTER (WHERE r > 0) AS rt
  FROM grams GROUP BY context
), p0 AS (
  SELECT win, even AS pa, even AS pr
  FROM (SELECT DISTINCT win FROM places), (SELECT 1.0::DOUBLE / (count(DISTINCT substr(win, 5, 1)) + 1) AS even FROM places)
), """ + ", ".join(_step(k) for k in range(1, 6)) + r""", ratios AS (
  SELECT win, round((ln(pa) - ln(pr)) * 1e9)::BIGINT AS ratio FROM p5
), scores AS (
  SELECT address, any_value(accepted) AS accepted, any_value(held) AS held,
         sum(ratio)::BIGINT::DOUBLE / 1e9 / count(*)::DOUBLE AS score
  FROM places JOIN ratios USING (win) GROUP BY address
), held AS (
  SELECT accepted, floor(least(greatest(score, -40), 40) * 256)::INTEGER AS bin FROM scores WHERE held AND accepted IS NOT NULL
), edges AS (
  SELECT bin FROM held UNION SELECT max(bin) + 1 FROM held
), tried AS (
  SELECT e.bin, count(*) FILTER (WHERE accepted) AS good, count(*) FILTER (WHERE NOT accepted) AS bad,
         count(*) FILTER (WHERE accepted AND h.bin < e.bin) AS below_a, count(*) FILTER (WHERE NOT accepted AND h.bin < e.bin) AS below_r
  FROM edges e, held h GROUP BY e.bin
), threshold AS (
  SELECT coalesce((SELECT bin / 256.0::DOUBLE FROM tried WHERE good > 0 AND bad > 0
    ORDER BY (good - below_a)::DOUBLE / good::DOUBLE + below_r::DOUBLE / bad::DOUBLE DESC, abs(bin), bin LIMIT 1), 0.0) AS t
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict,
       round(score, 6) AS score
FROM ruled JOIN scores USING (address), threshold
"""

OP6_KNN = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 20
"""

OP11_FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM p
"""

ORACLES = {
    "op1_mixing": OP1_MIXING,
    "op2_url_filter": OP2_URL_FILTER,
    "op6_knn": OP6_KNN,
    "op11_fill_in_middle": OP11_FILL_IN_MIDDLE,
}
