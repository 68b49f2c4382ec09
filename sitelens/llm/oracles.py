"""SQL statements (DuckDB) for the rows of the registered queries; used for checking only."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
wins AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY 1
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT l) AS n
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
    WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1
),
f AS (
    SELECT d.doc_id, source, len(w) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(lines.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
    FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (
    SELECT source, count(*) AS n, CAST(count(*) FILTER (WHERE base_failed) AS BIGINT) AS k FROM g GROUP BY source
),
m AS (SELECT 1.0::DOUBLE * sum(k) / sum(n) AS mu, sum(n)::DOUBLE AS total FROM h),
s AS (
    SELECT mu, total,
        (sum(n * (k / n - mu) * (k / n - mu)) - (count(*) - 1) * mu * (1 - mu))
        / nullif(sum(n) - sum(1.0::DOUBLE * n * n) / sum(n), 0) AS tau2
    FROM h, m GROUP BY mu, total
),
p AS (
    SELECT mu, CASE WHEN coalesce(tau2, 0) <= 0 THEN total ELSE greatest(1, least(total, mu * (1 - mu) / tau2 - 1)) END AS worth
    FROM s
),
v AS (SELECT source, n, k, (k + worth * mu) / (n + worth) <= 0.5 AS ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND ok AS kept, n AS host_docs, k AS host_failed
FROM g JOIN v ON g.source IS NOT DISTINCT FROM v.source
"""

OP3 = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
wins AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 200) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)),
later AS (SELECT doc_id, i FROM wins QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM later),
grouped AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
gone AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM grouped GROUP BY doc_id, span),
edges AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM gone
    UNION ALL
    SELECT doc_id, coalesce(max(b), 0), any_value(len(h) // 2) FROM d LEFT JOIN gone USING (doc_id) GROUP BY doc_id
),
kept AS (
    SELECT doc_id, coalesce(string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(2 * (y - x) AS BIGINT)), '' ORDER BY x), '') AS left_hex
    FROM edges JOIN d USING (doc_id) GROUP BY doc_id
),
n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(left_hex)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
wins AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
),
later AS (SELECT doc_id, i FROM wins QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
bags AS (
    SELECT doc_id, g, count(*) AS c FROM (
        SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
    ) GROUP BY 1, 2
),
total AS (SELECT doc_id, sum(c) AS n FROM bags GROUP BY 1),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, sum(least(a.c, b.c)) AS o
    FROM bags a JOIN bags b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT u, v FROM shared JOIN total x ON x.doc_id = u JOIN total y ON y.doc_id = v WHERE 5 * o >= 4 * (x.n + y.n - o)
),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, v FROM reach JOIN links ON other = u)
SELECT doc_id, min(other) AS class_id, min(other) = doc_id AS kept FROM reach GROUP BY doc_id
"""

OP8 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sound AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM sound WHERE list_dot_product(e, e) > 0),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM ok a JOIN ok b ON a.vec_id != b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95
),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT reach.vec_id, links.v FROM reach JOIN links ON other = u),
n AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(any_value(n.n), 0) AS n_links, min(other) AS component_id, min(other) = vec_id AS kept
FROM reach LEFT JOIN n USING (vec_id) GROUP BY vec_id
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11 = rf"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_PLAIN} AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS g
    FROM (SELECT item, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
),
d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
places AS (
    SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM wins) WHERE len(w) >= m)
),
found AS (SELECT DISTINCT doc_id, m, i, item FROM places JOIN wins USING (m, g)),
hit AS (
    SELECT doc_id, count(DISTINCT pos) AS n
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM found) GROUP BY doc_id
),
held AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(held.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

OP12 = rf"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
phrases AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
),
f AS (SELECT lang, k, phrase, count(*) AS n FROM phrases GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= 100),
parts AS (
    SELECT c.lang, phrase, n AS a, j, array_to_string(w[:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
),
scored AS (
    SELECT parts.lang, parts.phrase, a, x.n AS l, y.n AS r, total.n AS n, j,
        (1000 * CAST(a AS HUGEINT) * total.n) // (CAST(x.n AS HUGEINT) * y.n) AS score
    FROM parts JOIN f x ON x.lang = parts.lang AND x.phrase = head JOIN f y ON y.lang = parts.lang AND y.phrase = rest
    JOIN total ON total.lang = parts.lang
    QUALIFY row_number() OVER (PARTITION BY parts.lang, parts.phrase ORDER BY score, j) = 1
),
inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(n) AS most
    FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c WHERE k > 2)) GROUP BY 1, 2
),
ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase WHERE coalesce(100 * most < 100 * a, true)
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op3_suffix_dedup": OP3,
    "op5_recompression": OP5,
    "op6_bagminhash": OP6,
    "op8_pca_tiles": OP8,
    "op11_winnowing": OP11,
    "op12_collocations": OP12,
}
