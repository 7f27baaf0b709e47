"""The queries that SQL can express, as SQL for DuckDB over the same tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT page_id, payload, list_aggregate(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111',
           4 * (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) + 1, 4)), 'string_agg', '') AS bits
  FROM hashed
), named AS (
  SELECT page_id, payload, strlen(payload) AS payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
           + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
    min(page_id) OVER (PARTITION BY payload) AS response
  FROM bits
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to
FROM named
"""

OP6 = """
WITH sound AS (
  SELECT DISTINCT vec_id, list_transform(embedding::DOUBLE[], lambda x:
    x / greatest(list_max(embedding::DOUBLE[]), -list_min(embedding::DOUBLE[]))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), measured AS (
  SELECT vec_id, v, list_sum(list_transform(v, lambda x: x * x)) AS squares FROM sound
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))
    / sqrt(q.squares * c.squares) AS score
  FROM measured q JOIN measured c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP9 = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce('=' || source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
    ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, md5(text)), '7')), 1, 8))::BIGINT AS draw
  FROM documents
), worded AS (
  SELECT *, draw % greatest(4096, sum(n_tokens) OVER () // 1048576) AS block FROM counted WHERE n_tokens > 0
), blocks AS (
  SELECT source, block, sum(n_tokens)::BIGINT AS block_tokens FROM worded GROUP BY ALL
), totals AS (
  SELECT source, sum(block_tokens)::BIGINT AS tokens FROM blocks GROUP BY source
), shares AS (
  SELECT source, tokens, tokens / sum(tokens) OVER () AS share, sum(tokens) OVER () AS budget, count(*) OVER () AS sources
  FROM totals
), even AS (  -- halving: the largest exponent whose mix keeps 95 % of the largest entropy
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle END
  FROM (
    SELECT step, low, high, middle,
      (SELECT ln(sum(pow(share, middle))) - sum(pow(share, middle) * ln(pow(share, middle))) / sum(pow(share, middle))
         >= 0.95 * ln(max(sources)) FROM shares) AS ok
    FROM (SELECT *, CASE WHEN step = 0 THEN 1.0 ELSE (low + high) / 2 END AS middle FROM even WHERE step < 40)
  )
), rare AS (  -- halving: the largest exponent at which a source is read more than four times
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle END
  FROM (
    SELECT step, low, high, middle,
      (SELECT max(pow(share, middle) / tokens) / sum(pow(share, middle)) * max(budget) > 4 FROM shares) AS ok
    FROM (SELECT *, CASE WHEN step = 0 THEN 1.0 ELSE (low + high) / 2 END AS middle FROM rare WHERE step < 40)
  )
), chosen AS (
  SELECT floor(1000000 * CASE
      WHEN (SELECT count(*) FROM shares) = 1 THEN 1
      WHEN (SELECT max(1.0 / tokens) / count(*) * max(budget) > 4 FROM shares) AND r.low >= e.low THEN least(1.0, r.low + 2e-6)
      ELSE e.low END + 1e-9) / 1000000 AS x
  FROM (SELECT low FROM even ORDER BY step DESC LIMIT 1) e, (SELECT low FROM rare ORDER BY step DESC LIMIT 1) r
), weighed AS (
  SELECT source, tokens, x, pow(share, x) / sum(pow(share, x)) OVER () AS weight, budget FROM shares, chosen
), quotas AS (
  SELECT *, floor(weight * budget + 1e-6)::BIGINT // tokens AS passes, floor(weight * budget + 1e-6)::BIGINT % tokens AS rest
  FROM weighed
), placed AS (
  SELECT source, block, row_number() OVER turn AS turn, sum(block_tokens) OVER turn - block_tokens AS ahead
  FROM blocks
  WINDOW turn AS (PARTITION BY source ORDER BY
    ('0x' || substr(md5(concat_ws('|', block::VARCHAR, source, '7')), 1, 8))::BIGINT, block)
), each AS (
  SELECT w.*, p.turn, p.ahead, row_number() OVER inside AS slot,
    p.ahead + sum(n_tokens) OVER (inside ROWS UNBOUNDED PRECEDING) - n_tokens AS before
  FROM worded w JOIN placed p USING (source, block)
  WINDOW inside AS (PARTITION BY source, block ORDER BY draw, doc_id, n_tokens)
), timed AS (
  SELECT e.*, q.weight, q.x, q.passes + (e.before < q.rest)::BIGINT AS times FROM each e JOIN quotas q USING (source)
)
SELECT doc_id, CASE WHEN source <> '' THEN substr(source, 2) END AS source, n_tokens::BIGINT AS n_tokens,
  unnest(range(1, times + 1)) AS pass, turn AS block, slot, round(weight, 9) AS weight, x AS exponent
FROM timed WHERE times > 0
"""

LINKED = rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingled AS (
  SELECT doc_id, CASE
    WHEN len(words) >= 3 THEN list_distinct(list_transform(range(1, len(words) - 1), lambda i:
      words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')]
    ELSE [] END AS shingles
  FROM worded
), sets AS (
  SELECT doc_id, shingles, len(shingles) AS n FROM shingled
), rows AS (
  SELECT doc_id, n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS one, b.doc_id AS two
  FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= %d * (a.n + b.n - count(*))
), reached AS (
  SELECT DISTINCT one, one AS other FROM links
  UNION
  SELECT r.one, l.two FROM reached r JOIN links l ON l.one = r.other
), least AS (
  SELECT one, min(other) AS component_id FROM reached GROUP BY one
)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN least ON one = doc_id
"""

OP10 = LINKED % 90

OP12 = f"SELECT *, doc_id = component_id AS kept FROM ({LINKED % 85}) AS linked"

OP13 = rf"""
WITH named AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS terms
  FROM documents
), occurring AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM named
), kept AS (
  SELECT lang, term, count(*) AS total FROM occurring GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM occurring JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS whole FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS whole
  FROM (SELECT DISTINCT lang, source FROM named) g LEFT JOIN cells c USING (lang, source) GROUP BY ALL
), shares AS (  -- every group by every kept term
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.whole + 2 * l.v) AS p,
    1 + 1000000000::HUGEINT * (k.total + 2) // (l.whole + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), told AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM told
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLES = {
    "op1_warc": OP1, "op6_neighbours": OP6, "op9_mixing": OP9, "op10_ngram_join": OP10, "op12_minhash": OP12, "op13_divergence": OP13,
}
