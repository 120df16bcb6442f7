"""DuckDB SQL for the subpackage's queries, where SQL can express them."""

OP3 = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
    CASE WHEN regexp_matches(host || path, '^([^/]*[.-])?track[.-]') THEN 'tracker host'
         WHEN regexp_matches(host || path, '^[^/]+/([^/]+/)*login([/.]|$)') THEN 'sign-in page'
         WHEN regexp_matches(host || path, '^[^/]+/.*\.exe$') THEN 'program file'
         WHEN regexp_matches(host || path, '^[^/]+/.*\.zip$') THEN 'archive file'
         WHEN regexp_matches(host || path, '^[^/]+/([^/]+/)*cart([/.]|$)') THEN 'cart page'
         WHEN regexp_matches(host || path, '^([^/]*[.-])?ads[.-]') THEN 'ad host' END AS named
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN named IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN named END AS pattern
FROM ruled
"""

OP1 = r"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t
), tokens AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w
), starts AS (
  SELECT doc_id, i, lead(x, 7) OVER o IS NOT NULL AS whole, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o,
         lead(x, 4) OVER o, lead(x, 5) OVER o, lead(x, 6) OVER o, lead(x, 7) OVER o) AS win
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM starts WHERE whole
), reps AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM wins WHERE n > 1) GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, lang, text, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN reps USING (doc_id)
), scored AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS symbols, coalesce(1000 * n_capitals // nullif(word_chars, 0), 0) AS capitals,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeats, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS lines
  FROM counts
), labelled AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), trials AS (
  SELECT lang, text, min(quality) > 0 AS good, max(symbols) AS symbols, max(capitals) AS capitals, max(repeats) AS repeats, max(lines) AS lines
  FROM scored JOIN labelled USING (doc_id) WHERE NOT base_failed GROUP BY lang, text
), placed AS (
  SELECT lang, good, 10 * len(list_filter(range(10, 1001, 10), lambda t: t * t * t // 1000000 < symbols)) AS symbols,
         10 * len(list_filter(range(10, 1001, 10), lambda t: t * t // 1000 < capitals)) AS capitals,
         10 * len(list_filter(range(10, 1001, 10), lambda t: t < repeats)) AS repeats, 10 * len(list_filter(range(10, 1001, 10), lambda t: t < lines)) AS lines
  FROM trials
), tested AS (
  SELECT lang, step, count(*) FILTER (good) AS n, count(*) FILTER (good AND greatest(symbols, capitals, repeats, lines) >= step) AS k,
         count(*) FILTER (NOT good AND greatest(symbols, capitals, repeats, lines) >= step) AS bad, (SELECT count(*) FROM (SELECT DISTINCT lang FROM trials)) AS strata
  FROM placed, (SELECT unnest(range(10, 1001, 10)) AS step) GROUP BY lang, step
), passed AS (
  SELECT lang, step, bad FROM tested
  WHERE bad > 0 AND k < n * 0.02::DOUBLE
    AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                 + i * ln(0.02::DOUBLE) + (n - i) * ln(0.98::DOUBLE)))) <= 0.05::DOUBLE / strata
), best AS (
  SELECT lang, (max({'bad': bad, 'step': step})).step AS step FROM passed GROUP BY lang
), cuts AS (
  SELECT p.lang, (min(symbols) FILTER (symbols >= step) ** 3)::BIGINT // 1000000 AS symbols, (min(capitals) FILTER (capitals >= step) ** 2)::BIGINT // 1000 AS capitals,
         min(repeats) FILTER (repeats >= step) AS repeats, min(lines) FILTER (lines >= step) AS lines
  FROM placed p JOIN best b ON p.lang IS NOT DISTINCT FROM b.lang WHERE NOT good GROUP BY p.lang
), rejected AS (
  SELECT DISTINCT doc_id FROM scored s JOIN cuts c ON s.lang IS NOT DISTINCT FROM c.lang
  WHERE s.symbols > c.symbols OR s.capitals > c.capitals OR s.repeats > c.repeats OR s.lines > c.lines
)
SELECT s.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.doc_id IS NULL AS kept
FROM scored s LEFT JOIN rejected r USING (doc_id)
"""

OP4 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.f, c.f)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""

OP5 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, 0 AS k, 'assign' AS kind, 12 AS least,
         regexp_split_to_array(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS gaps,
         regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS hits,
         regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS measured
  FROM t
  UNION ALL SELECT doc_id, 1, 'access', 18, regexp_split_to_array(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'),
         regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM t
  UNION ALL SELECT doc_id, 2, 'hex', 16, regexp_split_to_array(text, '[0-9a-f]{16,}'), regexp_extract_all(text, '[0-9a-f]{16,}'),
         regexp_extract_all(text, '[0-9a-f]{16,}') FROM t
  UNION ALL SELECT doc_id, 3, 'entropy_hex', 20, regexp_split_to_array(text, '[0-9A-Fa-f]{20,}'), regexp_extract_all(text, '[0-9A-Fa-f]{20,}'),
         regexp_extract_all(text, '[0-9A-Fa-f]{20,}') FROM t
  UNION ALL SELECT doc_id, 4, 'entropy_base64', 20, regexp_split_to_array(text, '[A-Za-z0-9+/_=-]{20,}'),
         regexp_extract_all(text, '[A-Za-z0-9+/_=-]{20,}'), regexp_extract_all(text, '[A-Za-z0-9+/_=-]{20,}') FROM t
), each AS (
  SELECT doc_id, k, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, measured FROM m
), found AS (
  SELECT doc_id, k, kind, hits[i] AS hit, length(measured[i]) >= least AS ok,
         coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a
  FROM each
), base AS (
  SELECT doc_id, k, kind, a::BIGINT AS a, (a + length(hit))::BIGINT AS b FROM found WHERE k < 3 AND ok
), runs AS (
  SELECT row_number() OVER () AS r, doc_id, k, kind, hit, a, regexp_matches(hit, '(?i:example|sample|placeholder|changeme|dummy)|ABCDEFGHIJ|abcdefghij|0123456789') AS worded
  FROM found WHERE k >= 3 AND ok AND NOT regexp_matches(hit, '^[0-9]+$|^[a-z]+$|^[A-Z]?[a-z]+(?:[-/_][A-Za-z]?[a-z]+)*$|^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$')
), pieces AS (
  SELECT *, regexp_extract_all(hit, '[^+/_=-]*[+/_=-]|[^+/_=-]+') AS parts FROM runs WHERE worded
), part AS (
  SELECT r, doc_id, k, kind, a, i, parts[i] AS part, coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) AS before,
         regexp_matches(parts[i], '(?i:example|sample|placeholder|changeme|dummy)|ABCDEFGHIJ|abcdefghij|0123456789') AS bad
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM pieces)
), stretch AS (
  SELECT doc_id, k, kind, string_agg(part, '' ORDER BY i) AS hit, a + min(before) AS a
  FROM (SELECT *, count(*) FILTER (bad) OVER (PARTITION BY r ORDER BY i) AS g FROM part) WHERE NOT bad GROUP BY r, doc_id, k, kind, a, g
), cand AS (
  SELECT row_number() OVER () AS c, * FROM (
    SELECT doc_id, k, kind, hit, a FROM runs WHERE NOT worded
    UNION ALL SELECT doc_id, k, kind, hit, a FROM stretch WHERE length(hit) >= 20
      AND NOT regexp_matches(trim(hit, '+/_=-'), '^[0-9]+$|^[a-z]+$|^[A-Z]?[a-z]+(?:[-/_][A-Za-z]?[a-z]+)*$|^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$'))
), win AS (
  SELECT c, doc_id, k, kind, a, unnest(range(0, length(hit) - 19)) AS i, hit FROM cand
), chars AS (
  SELECT c, doc_id, k, kind, a, i, unnest(string_split(substr(hit, (i + 1)::BIGINT, 20), '')) AS ch FROM win
), counted AS (
  SELECT c, doc_id, k, kind, a, i, ch, count(*) AS n FROM chars GROUP BY ALL
), hot AS (
  SELECT c, doc_id, k, kind, a, i FROM counted GROUP BY ALL
  HAVING sum(round(n * log2(n) * 1e6)) <= floor(20 * (log2(20) - CASE k WHEN 3 THEN 3.05::DOUBLE ELSE 3.64::DOUBLE END) * 1e6)
), marked AS (
  SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY c ORDER BY i) + 20 THEN 0 ELSE 1 END AS fresh FROM hot
), isles AS (
  SELECT *, sum(fresh) OVER (PARTITION BY c ORDER BY i) AS g FROM marked
), spans AS (
  SELECT * FROM base UNION ALL SELECT doc_id, k, kind, (a + min(i))::BIGINT, (a + max(i) + 20)::BIGINT FROM isles GROUP BY c, doc_id, k, kind, a, g
), per AS (
  SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN per USING (doc_id)
"""

OP7 = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents
), s AS (
  SELECT doc_id, h, (length(x) // 2 + 1)::BIGINT AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS text_crc32
  FROM d, tab
), cum AS (
  SELECT *, (sum(size) OVER (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before, (sum(size) OVER ())::BIGINT AS total FROM s
), edges AS (
  SELECT k, arg_min(p, (abs(16 * p - total * k), p)) AS edge
  FROM (SELECT before AS p, total FROM cum UNION ALL SELECT DISTINCT total, total FROM cum), (SELECT unnest(range(1, 16)) AS k) GROUP BY k
), placed AS (
  SELECT *, (SELECT count(*) FROM edges WHERE edge <= before)::INTEGER AS shard FROM cum
)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY before) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS o
  FROM documents
), s AS (
  SELECT source, source_size, pos, [5, 2, 1][(pos - 1) % 3 + 1] AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM d GROUP BY source)
), r AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS reach, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total FROM s
), l AS (
  SELECT *, (total - coalesce(sum(cap) OVER before, 0)::DOUBLE) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM r WINDOW before AS (ORDER BY reach, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM l WHERE level <= reach ORDER BY reach, pos LIMIT 1
), t AS (
  SELECT source, source_size, pos, total, least(weight * coalesce((SELECT level FROM chosen), 0), cap::DOUBLE) AS target FROM l
), plan AS (
  SELECT source, source_size, target, floor(target)::BIGINT AS words FROM t
), ring AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY o ROWS UNBOUNDED PRECEDING) - size AS place FROM d
)
SELECT doc_id, size, source_size, target,
       (size * coalesce(words // nullif(source_size, 0), 0)
        + greatest(0, least(size, coalesce(words % nullif(source_size, 0), 0) - place)))::BIGINT AS taken
FROM ring JOIN plan ON ring.source IS NOT DISTINCT FROM plan.source
"""

OP11 = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), d AS (
  SELECT doc_id, source, hex(encode(doc_id::VARCHAR)) AS x, text,
    list_aggregate(list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR], lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') AS head
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) % 5 = 0
      THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM d, tab
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS size,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n FROM leaves
), low(g, level, n, size, digest) AS (
  SELECT g, 0, n, size, leaf FROM placed
  UNION ALL SELECT g, level + 1, n // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY n)) FROM low WHERE size > 1 GROUP BY ALL
), tops AS (
  SELECT g, level AS height, digest AS subroot FROM low WHERE size = 1
), high(level, n, size, digest) AS (
  SELECT 0, g, (SELECT count(*) FROM tops), subroot FROM tops
  UNION ALL SELECT level + 1, n // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY n)) FROM high WHERE size > 1 GROUP BY ALL
), nodes AS (
  SELECT g, level, n, level < height AS under, digest FROM low JOIN tops USING (g)
), sides AS (
  SELECT g, level, n, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM nodes WHERE under WINDOW w AS (PARTITION BY g, level, n // 16 ORDER BY n)
  UNION ALL
  SELECT t.g, t.height + h.level, 0, h.a, h.b FROM tops t JOIN (
    SELECT level, n, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
      coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
    FROM high WHERE size > 1 WINDOW w AS (PARTITION BY level, n // 16 ORDER BY n)
  ) h ON h.n = t.g // (16 ** h.level)::BIGINT
), climb(g, n, level, spot, hash, proof) AS (
  SELECT g, n, 0, n, coalesce(tampered, leaf), '' FROM placed
  UNION ALL
  SELECT c.g, c.n, c.level + 1, c.spot // 16, sha256(s.a || c.hash || s.b), c.proof || s.a || s.b
  FROM climb c JOIN sides s ON s.g = c.g AND s.level = c.level AND s.n = c.spot
), ends AS (
  SELECT g, n, arg_max(hash, level) AS hash, arg_max(proof, level) AS proof FROM climb GROUP BY g, n
)
SELECT doc_id, leaf, subroot, (SELECT digest FROM high WHERE size = 1) AS root, sha256(proof) AS proof_sha256, hash AS folded_root,
  hash = (SELECT digest FROM high WHERE size = 1) AS verified
FROM placed JOIN tops USING (g) JOIN ends USING (g, n)
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op3_url_filters": OP3,
    "op4_exact_top_k": OP4,
    "op5_secret_scans": OP5,
    "op7_sharding": OP7,
    "op8_mixing": OP8,
    "op11_merkle_manifest": OP11,
}
