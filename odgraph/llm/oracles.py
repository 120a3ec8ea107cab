"""DuckDB SQL of the registered corpus queries that SQL can express."""

from odgraph.llm.licenses import TEMPLATES

SQL = {}

SQL["op2_embedding"] = r"""
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM usable a, usable b
  WHERE a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(r, b) AS (
  SELECT r, r FROM usable
  UNION
  SELECT reach.r, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.r, min(vec_id) AS component_id FROM reach JOIN vectors v ON v.r = reach.b GROUP BY reach.r),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM vectors LEFT JOIN least USING (r) LEFT JOIN counted ON counted.a = vectors.r
"""

SQL["op3_license_scan"] = r"""
WITH templates(name, line) AS (VALUES
{templates}),
bags AS (
  SELECT name, term, count(*) AS n
  FROM (SELECT name, unnest(regexp_extract_all(translate(line, '{upper}', '{lower}'), '[a-z0-9]+')) AS term FROM templates)
  GROUP BY name, term),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*)::DOUBLE)) + 1 AS idf FROM bags GROUP BY term),
vectors AS (
  SELECT name, term, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY name)) AS weight
  FROM bags JOIN idf USING (term)),
files AS (
  SELECT row_number() OVER () AS r, doc_id, translate(text, '{upper}', '{lower}') AS text,
         concat_ws('/', source, lang, (doc_id // 100)::VARCHAR, doc_id::VARCHAR) AS path,
         concat_ws('/', source, lang, (doc_id // 100)::VARCHAR) AS dir
  FROM documents),
units AS (
  SELECT r, 0 AS unit, text AS line FROM files
  UNION ALL
  SELECT r, unnest(range(1, len(l) + 1)) AS unit, unnest(l) AS line
  FROM (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[a-z0-9]')) AS l FROM files)),
terms AS (
  SELECT r, unit, term, count(*) AS n
  FROM (SELECT r, unit, unnest(regexp_extract_all(line, '[a-z0-9]+')) AS term FROM units) GROUP BY r, unit, term),
weighed AS (
  SELECT r, unit, term, n * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS x
  FROM terms LEFT JOIN idf USING (term)),
norms AS (SELECT r, unit, sqrt(sum(x * x)) AS norm FROM weighed GROUP BY r, unit),
scores AS (
  SELECT r, unit, name, round(sum(x * weight) / any_value(norm), 6) AS score
  FROM weighed JOIN vectors USING (term) JOIN norms USING (r, unit)
  GROUP BY r, unit, name HAVING round(sum(x * weight) / any_value(norm), 6) >= 0.8),
own AS (
  SELECT r, max(score) AS own_score, min_by(name, (-score, name)) AS own_license, bool_or(unit <= 1) AS declares
  FROM scores GROUP BY r),
declared AS (
  SELECT dir, min_by(own_license, (-own_score, path)) AS given
  FROM files JOIN own USING (r) WHERE declares GROUP BY dir),
near AS (
  SELECT r, min_by(d.given, -length(d.dir)) AS given, min_by(d.dir, -length(d.dir)) AS near_dir
  FROM files f JOIN declared d ON f.dir = d.dir OR starts_with(f.dir, d.dir || '/')
  GROUP BY r)
SELECT doc_id, path, own_license, own_score, coalesce(own_license, given) AS license,
       CASE WHEN own_license IS NULL THEN near_dir END AS inherited_from
FROM files LEFT JOIN own USING (r) LEFT JOIN near USING (r)
""".replace("{templates}", ",\n".join(f"  ('{n}', '{t}')" for n, t in TEMPLATES)).replace(
    "{upper}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").replace("{lower}", "abcdefghijklmnopqrstuvwxyz")

SQL["op4_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') END AS raw_host,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
              ELSE regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END AS path
  FROM pages),
hosts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
  FROM parts),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/' END AS rule
  FROM hosts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

SQL["op6_line_dedup"] = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT r, doc_id, pos, line,
         array_to_string(list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
                         lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END), ' ') AS masked
  FROM (SELECT r, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM docs)),
counted AS (
  SELECT masked, string_split(masked, ' ') AS tokens, count(DISTINCT r) AS docs,
         min(doc_id) AS first_id, max(doc_id) AS last_id
  FROM lines WHERE masked <> '' GROUP BY masked),
links AS (
  SELECT a.masked AS a, b.masked AS b FROM counted a JOIN counted b
    ON len(a.tokens) = len(b.tokens) AND a.tokens[1:3] = b.tokens[1:3] AND a.masked <> b.masked
  WHERE len(list_filter(list_zip(a.tokens, b.tokens), lambda p: p[1] <> p[2]))
        <= floor(len(a.tokens) * (1 - 0.8) + 1e-9)),
reach(masked, b) AS (
  SELECT masked, masked FROM counted
  UNION
  SELECT reach.masked, links.b FROM reach JOIN links ON reach.b = links.a),
often AS (
  SELECT reach.masked, min(first_id) AS first_id
  FROM reach JOIN counted c ON c.masked = reach.b
  GROUP BY reach.masked HAVING sum(docs) >= CASE WHEN any_value(len(tokens)) >= 51 THEN 2 ELSE 5 END AND min(first_id) <> max(last_id)),
kept AS (
  SELECT r, coalesce(string_agg(line, chr(10) ORDER BY pos)
                     FILTER (WHERE first_id IS NULL OR doc_id = first_id), '') AS text,
         count(*) FILTER (WHERE first_id IS NOT NULL AND doc_id <> first_id) AS n_dropped
  FROM lines LEFT JOIN often USING (masked) GROUP BY r)
SELECT doc_id, CASE WHEN docs.text IS NULL THEN NULL ELSE kept.text END AS text,
       coalesce(len(parts), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM docs LEFT JOIN kept USING (r)
"""

SQL["op8_mixing"] = r"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
total AS (SELECT 1.5 * sum(source_size)::DOUBLE AS t FROM ranked),
filling AS (
  SELECT 0 AS step, (SELECT t / sum(weight) FROM total, ranked GROUP BY t) AS level
  UNION ALL
  SELECT step + 1,
         (SELECT (any_value(t) - coalesce(sum(2.0 * source_size) FILTER (WHERE 2.0 * source_size <= weight * level), 0))
                 / nullif(sum(weight) FILTER (WHERE 2.0 * source_size > weight * level), 0)
          FROM ranked, total)
  FROM filling WHERE step < (SELECT count(*) FROM ranked) AND level IS NOT NULL),
final AS (SELECT max(level) AS level FROM filling),
targets AS (
  SELECT source, source_size,
         CASE WHEN 2.0 * source_size <= weight * level THEN 2.0 * source_size ELSE weight * level END AS target
  FROM ranked, final),
placed AS (
  SELECT s.r, doc_id, size, source_size, target, round(target)::BIGINT AS goal,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size, r
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (CASE WHEN source_size = 0 THEN 0 ELSE
          (goal // source_size) * size
          + least(size, greatest(goal - (goal // source_size) * source_size - start, 0)) END)::BIGINT AS taken
FROM placed
"""

SQL["op10_decontaminate"] = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS width, w[i : i + least(10, len(w)) - 1] AS grams
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
places AS (
  SELECT r, width, i, w[i : i + width - 1] AS grams
  FROM (SELECT r, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM doc_words, (SELECT DISTINCT width FROM windows) WHERE len(w) >= width)),
hits AS (SELECT r, i, p.width, item FROM places p JOIN windows USING (width, grams)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + width)) AS k FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
