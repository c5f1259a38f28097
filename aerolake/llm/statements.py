"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from aerolake.llm import licenses, urls, warc


def license_sql() -> str:
    names = " ".join(f"WHEN '{wording}' THEN '{name}'" for wording, name in licenses.known().items())
    run = "list_aggregate(list_transform(ids, lambda x: '[' || x || ']'), 'string_agg', '')"
    run = f"coalesce({run}, '')"
    for parts, licence in licenses.RULES:
        run = f"replace({run}, '{''.join(f'[{p}]' for p in parts)}', '<{licence}>')"
    return f"""
WITH cut AS (
  SELECT doc_id, string_split_regex(regexp_replace(
    translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}'),
    '([.!?;:])[ \\t]+', '\\1' || chr(10), 'g'), '[\\r\\n]+') AS s
  FROM documents
), named AS (
  SELECT doc_id, list_filter(list_transform(s, lambda x:
    CASE trim(regexp_replace(x, '[^a-z0-9]+', ' ', 'g')) {names} END), lambda x: x IS NOT NULL) AS ids
  FROM cut
), resolved AS (
  SELECT doc_id, ids, {run} AS run FROM named
)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS identifiers,
  coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(run, '<([^>]+)>', 1))), ','), '') AS licences,
  coalesce(array_to_string(regexp_extract_all(run, '\\[([^\\]]+)\\]', 1), ','), '') AS leftovers,
  CAST(len(regexp_extract_all(run, '<([^>]+)>', 1)) AS BIGINT) AS matches
FROM resolved"""


def url_sql() -> str:
    rule, verdict = "NULL", "NULL"
    for word, text in reversed(urls.by_length(urls.RULES)):
        own, slash, start = text.partition("/")
        fit = f"(host = '{own}' OR ends_with(host, '.{own}')) AND starts_with(path, '{slash}{start}')"
        rule, verdict = (f"CASE WHEN {fit} THEN '{x}' ELSE {y} END" for x, y in ((text, rule), (word, verdict)))
    lower = f"'{urls.UPPER}', '{urls.LOWER}'"
    link = urls.LINK.replace("'", "''")
    steps, last = "", "seeds"
    for turn in range(1, urls.ROUNDS + 1):
        steps += f""", s{turn} AS MATERIALIZED (
  SELECT kind, host, CAST(sum(score) AS HUGEINT) AS score FROM (
    SELECT o.kind, o.target AS host, x.score * CAST({urls.DAMPING} AS HUGEINT) // CAST(100 * o.degree AS HUGEINT) AS score
    FROM out o JOIN {last} x ON o.kind = x.kind AND o.source = x.host
    UNION ALL SELECT kind, host, score * CAST({100 - urls.DAMPING} AS HUGEINT) // 100 FROM seeds) GROUP BY ALL)"""
        last = f"s{turn}"
    return f"""
WITH rest AS (
  SELECT page_id, html, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS r
  FROM pages
), split AS (
  SELECT page_id, html, translate(regexp_extract(r, '^([^/?#]*)', 1), {lower}) AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS MATERIALIZED (
  SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM split
), hosts AS MATERIALIZED (
  SELECT host, count(*) FILTER (verdict = 'allow') AS allowed, count(*) FILTER (verdict = 'block') AS blocked
  FROM ruled WHERE host <> '' GROUP BY host
), links AS MATERIALIZED (
  SELECT source, target FROM (
    SELECT DISTINCT source, translate(regexp_replace(regexp_replace(link, '{urls.USER}', ''), '{urls.PORT}', ''), {lower}) AS target
    FROM (SELECT host AS source, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM split))
  WHERE source <> '' AND source <> target AND target IN (SELECT host FROM hosts)
  UNION SELECT host, regexp_extract(host, '^[^.]+\\.(.+)$', 1) FROM hosts
    WHERE regexp_extract(host, '^[^.]+\\.(.+)$', 1) IN (SELECT host FROM hosts)
  UNION SELECT regexp_extract(host, '^[^.]+\\.(.+)$', 1), host FROM hosts
    WHERE regexp_extract(host, '^[^.]+\\.(.+)$', 1) IN (SELECT host FROM hosts)
), edges AS (
  SELECT 'allow' AS kind, source, target FROM links UNION ALL SELECT 'block', target, source FROM links
), out AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY kind, source) AS degree FROM edges
), seeds AS MATERIALIZED (
  SELECT 'allow' AS kind, host, CAST(CAST(allowed AS HUGEINT) * ({urls.UNIT} // greatest(1, (SELECT sum(allowed) FROM hosts))) AS HUGEINT) AS score
  FROM hosts WHERE allowed > 0
  UNION ALL
  SELECT 'block', host, CAST(CAST(blocked AS HUGEINT) * ({urls.UNIT} // greatest(1, (SELECT sum(blocked) FROM hosts))) AS HUGEINT)
  FROM hosts WHERE blocked > 0
){steps}, of_host AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'allow'), 0) AS trust,
    coalesce(sum(score) FILTER (kind = 'block'), 0) AS distrust FROM {last} GROUP BY host
)
SELECT r.page_id, r.host, r.path, r.rule,
  coalesce(r.verdict, CASE WHEN coalesce(h.distrust, 0) > coalesce(h.trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(coalesce(h.trust, 0) // {urls.UNIT // 10**12} AS BIGINT) AS trust,
  CAST(coalesce(h.distrust, 0) // {urls.UNIT // 10**12} AS BIGINT) AS distrust
FROM ruled r LEFT JOIN of_host h USING (host)"""


_USABLE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

# Brute force over all pairs of the query set and the rows.
ONEBIT = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, q.e AS qe, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, qe ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5"""

HAMMING = f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings
  WHERE {_USABLE} AND len(embedding) > 0
), scored AS (
  SELECT q.vec_id AS query_id, q.b AS qb, c.vec_id,
    CAST(len(list_filter(list_zip(q.b, c.b), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
  FROM v q JOIN v c ON len(q.b) = len(c.b) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, qb ORDER BY distance, vec_id) AS INTEGER) AS rank,
    vec_id, distance FROM scored
)
SELECT * FROM ranked WHERE rank <= 10"""


def merkle_sql() -> str:
    end = "chr(13) || chr(10)"
    parts = [
        "'WARC/1.1'", end, "'WARC-Type: response'", end, "'WARC-Record-ID: <urn:page:'", "coalesce(CAST(page_id AS VARCHAR), '')",
        "'>'", end, "'WARC-Target-URI: '", "coalesce(url, '')", end, "'Content-Type: text/html; charset=utf-8'", end,
        "'Content-Length: '", "CAST(strlen(coalesce(html, '')) AS VARCHAR)", end, end, "coalesce(html, '')",
    ]
    fan, levels = warc.FANOUT, ""
    for level in range(1, warc.HEIGHT + 1):
        levels += f""", n{level} AS MATERIALIZED (
  SELECT replica, node // {fan} AS node, CAST(sum(length) AS BIGINT) AS length,
    sha256(string_agg(CAST(node % {fan} AS VARCHAR) || ':' || digest, ',' ORDER BY node)) AS digest
  FROM n{level - 1} GROUP BY replica, node // {fan})"""
    sides = " UNION ALL ".join(
        f"""SELECT {level} AS level, coalesce(a.node, b.node) AS node, a.digest AS digest_a, b.digest AS digest_b,
    coalesce(a.length, 0) AS length_a, coalesce(b.length, 0) AS length_b
  FROM (SELECT * FROM n{level} WHERE replica = 'a') a FULL JOIN (SELECT * FROM n{level} WHERE replica = 'b') b USING (node)"""
        for level in range(warc.HEIGHT + 1)
    )
    return f"""
WITH records AS (
  SELECT page_id, {' || '.join(parts)} AS whole, substr(md5(coalesce(url, '')), 1, 2) AS kind FROM pages
), damaged AS (
  SELECT *, CASE kind WHEN '01' THEN NULL WHEN '02' THEN substr(whole, 1, length(whole) // 2)
    WHEN '00' THEN substr(whole, 1, length(whole) // 2) || '#' || substr(whole, length(whole) // 2 + 2)
    ELSE whole END AS other FROM records
), leaves AS (
  SELECT page_id, sha256(whole) AS digest, strlen(whole) + 4 AS length, sha256(other) AS digest_b,
    strlen(other) + 4 AS length_b, count(*) AS copies FROM damaged GROUP BY ALL
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, digest) - 1 AS position FROM leaves
), n0 AS MATERIALIZED (
  SELECT 'a' AS replica, position AS node, digest, length * copies AS length FROM placed
  UNION ALL SELECT 'b', position, digest_b, length_b * copies FROM placed WHERE digest_b IS NOT NULL
){levels}, sides AS (
  {sides}
), placed_sides AS (
  SELECT *, CAST(coalesce(sum(length_a) OVER (PARTITION BY level ORDER BY node
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM sides
)
SELECT CAST(s.level AS INTEGER) AS level, s.node, CAST(s.node * {fan} ** s.level AS BIGINT) AS first_position, s."offset",
  s.length_a, s.length_b, s.digest_a, s.digest_b,
  CASE WHEN s.level > 0 THEN 'branch' WHEN s.digest_b IS NULL THEN 'lost' WHEN s.digest_a IS NULL THEN 'extra'
    WHEN s.length_a <> s.length_b THEN 'resized' ELSE 'altered' END AS damage, p.page_id
FROM placed_sides s LEFT JOIN placed p ON s.level = 0 AND s.node = p.position
WHERE s.digest_a IS DISTINCT FROM s.digest_b"""


RANKED = """
WITH read AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM read
), items AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), asked AS (
  SELECT item, item_id, unnest(terms) AS term FROM items
), held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM read)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, n_docs
), sizes AS (
  SELECT r, doc_id, 50 + (50 * len(terms) * n_docs) // n_terms AS m FROM read, totals WHERE doc_id IS NOT NULL AND len(terms) > 0
), scored AS (
  SELECT item, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (r) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""

JACCARD = """
WITH RECURSIVE read AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
    END AS s
  FROM read
), held AS MATERIALIZED (
  SELECT r, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM held a JOIN held b USING (shingle) WHERE a.r <> b.r
  GROUP BY a.r, a.n, b.r, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
  SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT x.doc_id, CAST(len(x.s) AS BIGINT) AS n_shingles, least(x.doc_id, min(y.doc_id)) AS component_id
FROM sets x LEFT JOIN reached ON reached.a = x.r LEFT JOIN sets y ON y.r = reached.b GROUP BY x.r, x.doc_id, x.s"""

NEGATIVES = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
