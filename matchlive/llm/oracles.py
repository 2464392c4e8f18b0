"""The operators' queries as DuckDB SQL, where SQL can express them."""

# Shares of character classes and of each language's 40 commonest words, against the mean of the
# documents that pass the base rules; 20 of these make a reference.
OP1 = r"""
WITH w AS (
  SELECT doc_id, coalesce('=' || lang, 'null') AS lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
runs AS (
  SELECT doc_id, p, array_to_string(words[p:p + 2], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM w)
),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM runs) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS i FROM again) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w
),
base AS (
  SELECT w.doc_id, lang, t, words, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, length(t) AS n_chars
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
classes AS (
  SELECT doc_id, lang, base_failed, n_chars, unnest([
    length(regexp_replace(t, '[^a-z]', '', 'g')), length(regexp_replace(t, '[^A-Z]', '', 'g')),
    length(regexp_replace(t, '[^0-9]', '', 'g')), length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')),
    n_symbols, length(regexp_replace(t, '[^!-/:-@\[-`{-~]', '', 'g')) - n_symbols,
    length(regexp_replace(t, '[^\x00-\x08\x0E-\x1F\x7F]', '', 'g')),
    length(regexp_replace(t, '[\x00-\x7F]', '', 'g'))]) / greatest(n_chars, 1) AS share, unnest(range(8)) AS place
  FROM judged
),
known AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place
  FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(list_distinct(words)) AS word FROM w) GROUP BY ALL)
  QUALIFY place <= 40
),
times AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM w) GROUP BY ALL),
common AS (
  SELECT doc_id, judged.lang, base_failed, n_words, place, coalesce(n, 0) / greatest(n_words, 1) AS share
  FROM judged JOIN known ON known.lang = judged.lang LEFT JOIN times USING (doc_id, word)
),
both_ AS (
  SELECT 'classes' AS kind, doc_id, lang, base_failed, n_chars >= 200 AS long_enough, place, share FROM classes
  UNION ALL SELECT 'words', doc_id, lang, base_failed, n_words >= 200, place, share FROM common
  UNION ALL SELECT 'words', doc_id, lang, base_failed, any_value(n_words) >= 200, 0,
    CASE WHEN any_value(n_words) > 0 THEN 1 - sum(share) ELSE 0 END FROM common GROUP BY doc_id, lang, base_failed
),
refs AS (
  SELECT kind, lang, place, avg(share) AS r FROM both_ WHERE NOT base_failed GROUP BY ALL HAVING count(*) >= 20
),
bits AS (
  SELECT kind, doc_id, long_enough,
    sum(CASE WHEN share > 0 THEN share * log2(share / ((share + r) / 2)) ELSE 0 END
      + CASE WHEN r > 0 THEN r * log2(r / ((share + r) / 2)) ELSE 0 END) / 2 AS b
  FROM both_ JOIN refs USING (kind, lang, place) GROUP BY ALL
),
far AS (SELECT kind, doc_id, sqrt(least(1, greatest(0, b))) AS d FROM bits WHERE long_enough),
found AS (
  SELECT judged.*, c.d AS class_distance, x.d AS word_distance
  FROM judged LEFT JOIN far c ON c.doc_id = judged.doc_id AND c.kind = 'classes'
  LEFT JOIN far x ON x.doc_id = judged.doc_id AND x.kind = 'words'
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance,
  NOT base_failed AND coalesce(class_distance <= 0.25, true) AND coalesce(word_distance <= 0.30, true) AS kept
FROM found
"""

# Vectors without a finite direction link with nothing; components by walking links from every vector.
OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
),
u AS (
  SELECT vec_id, e, len(e) AS size, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_sum(list_transform(e, lambda x: abs(x))) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.size = b.size AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
),
reach AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION
  SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""

OP6 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes
  FROM pages
),
d AS (SELECT page_id, payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS smallest FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > smallest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > smallest THEN smallest END AS refers_to
FROM f
"""

# Characters added by the template: system 19, user 17, assistant 6, others 17 and the role; one for each escape.
OP9 = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL
  SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(
    length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<<SYS>>|<</SYS>>|<\||\|>'))
    + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 18 WHEN 'assistant' THEN 6 ELSE 17 + length(role) END
  )::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

OP10 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
s AS (
  SELECT doc_id, p, array_to_string(words[p:p + 49], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w)
),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS m FROM s) WHERE m < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM r),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (
  SELECT doc_id, len(words) AS n_words, len(coalesce(gone, [])) AS n_removed,
    CASE WHEN gone IS NULL THEN words
      ELSE list_transform(list_filter(range(1, len(words) + 1), lambda i: NOT list_contains(gone, i)), lambda i: words[i])
    END AS kept
  FROM w LEFT JOIN g USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""

# Shares are in billionths; the distance of two sources is summed over all kept terms, held by either or not.
OP11 = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
g AS (SELECT DISTINCT lang, source FROM d),
k AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30
),
n AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM d)
  SEMI JOIN k USING (lang, term) GROUP BY ALL
),
c AS (
  SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)
),
p AS (
  SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 5)
    // (sum(n) OVER s + 5 * count(*) OVER s))::BIGINT AS p FROM c WINDOW s AS (PARTITION BY lang, source)
),
q AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER s + 5 * count(*) OVER s))::BIGINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) WINDOW s AS (PARTITION BY lang)
),
t AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
),
f AS (
  SELECT a.lang AS lang, a.source AS source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
o AS (
  SELECT a.lang AS lang, a.source AS source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM t UNION ALL SELECT * FROM o)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def lloyd(rounds: int = 10) -> str:
    """Rounds of assignment and means in whole numbers, one after the other."""
    apart = "list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::BIGINT"
    steps = ""
    for number in range(rounds + 1):
        steps += f""",
a{number} AS MATERIALIZED (
  SELECT k, any_value(vec_id) AS vec_id, any_value(v.e) AS e, min([{apart}, c.n]) AS best FROM v, c{number} c GROUP BY k
)"""
        if number < rounds:
            steps += f""",
s{number} AS MATERIALIZED (
  SELECT n, list(x ORDER BY i) AS e FROM (
    SELECT n, i, (s - ((s % c) + c) % c) // c AS x
    FROM (SELECT best[2] AS n, i, sum(e[i])::BIGINT AS s, count(*) AS c FROM a{number}, range(1, 65) r(i) GROUP BY ALL)
  ) GROUP BY n
),
c{number + 1} AS MATERIALIZED (SELECT n, coalesce(s.e, c.e) AS e FROM c{number} c LEFT JOIN s{number} s USING (n))"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, e FROM v QUALIFY n < 8
){steps}
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance,
  (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia, (sum(best[1]) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.n = best[2]
"""


OP12 = lloyd()

# Windows of ten words, or of all words of a shorter item, wherever they occur.
OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
w AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS m, array_to_string(words[s:s + 9], ' ') AS text
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM b WHERE len(words) > 0)
),
o AS (
  SELECT k, s, d.m AS m, item_id
  FROM (
    SELECT k, m, s, array_to_string(words[s:s + m - 1], ' ') AS text
    FROM (SELECT k, words, m, unnest(range(1, len(words) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM w))
  ) d JOIN w ON w.m = d.m AND w.text = d.text
),
h AS (SELECT k, count(*) AS n_hit FROM (SELECT DISTINCT k, unnest(range(s, s + m)) AS i FROM o) GROUP BY k),
i AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, item_id::VARCHAR AS item FROM o WHERE item_id IS NOT NULL) GROUP BY k
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (k) LEFT JOIN i USING (k)
"""
