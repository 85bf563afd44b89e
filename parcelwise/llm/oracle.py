"""Independent SQL for the queries of this subpackage that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op1_warc_reassembly"] = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
firsts AS (SELECT body, max(page_id) AS first FROM bodies GROUP BY body),
hashed AS (SELECT page_id, body, first, sha1(body) AS hex FROM bodies JOIN firsts USING (body))
SELECT page_id,
       strlen(body) AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (5 * (i // 4) + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)
            + 1)::INTEGER, 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""

ORACLE["op7_poisson_mixing"] = """
WITH RECURSIVE sizes AS (SELECT source, sum(length(text)) AS size FROM documents GROUP BY source),
rates AS (
    SELECT source, sum(size) OVER () * (1.0::DOUBLE / count(*) OVER ()) / size AS rate FROM sizes
),
steps AS (
    SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS below FROM rates
    UNION ALL
    SELECT source, rate, k + 1, p * rate / (k + 1), below + p * rate / (k + 1)
    FROM steps WHERE k < rate + 12 * sqrt(rate) + 40
),
tables AS (SELECT source, list(below ORDER BY k) AS below FROM steps GROUP BY source),
drawn AS (
    SELECT d.*, len(list_filter(t.below, lambda p:
        p <= ('0x' || substr(md5('7|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)) AS copies
    FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
),
copied AS (SELECT * EXCLUDE (copies), unnest(range(1, copies + 1))::INTEGER AS copy FROM drawn)
SELECT *, ('0x' || substr(md5('7|order|' || doc_id || '|' || copy), 1, 13))::BIGINT
          / 4503599627370496.0::DOUBLE AS shuffle_key
FROM copied
"""

ORACLE["op8_voronoi_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE["op9_spherical_caps"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reach AS (
    SELECT a AS node, b AS other FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a),
roots AS (SELECT node AS vec_id, min(least(node, other)) AS root FROM reach GROUP BY node)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, vec_id) AS component_id,
       coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN roots USING (vec_id)
"""

ORACLE["op10_jaccard_relations"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]))
        END AS s
    FROM words
),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
frequent AS (SELECT g, count(*) AS df FROM grams GROUP BY g),
ordered AS (
    SELECT doc_id, n, g, row_number() OVER (PARTITION BY doc_id ORDER BY df, g) AS k
    FROM grams JOIN frequent USING (g)
),
prefixes AS (SELECT doc_id, n, g FROM ordered WHERE k <= n - ceil(0.9 * n - 0.000001) + 1),
candidates AS (
    SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM prefixes x JOIN prefixes y
    ON x.g = y.g AND x.doc_id < y.doc_id AND 100 * least(x.n, y.n) >= 90 * greatest(x.n, y.n)
),
verified AS (
    SELECT a, b FROM candidates c JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * len(list_intersect(x.s, y.s)) >= 90 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))
),
links AS (SELECT a, b FROM verified UNION ALL SELECT b, a FROM verified),
reach AS (
    SELECT a AS node, b AS other FROM links
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
roots AS (SELECT node AS doc_id, min(least(node, other)) AS root FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
FROM sets LEFT JOIN roots USING (doc_id)
"""

ORACLE["op11_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
        lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM words, (SELECT unnest(range(1, 6)) AS k)
),
counts AS (
    SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
),
cuts AS (
    SELECT lang, phrase, f AS a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w
    FROM counts WHERE k > 1
),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.cut, (1000 * c.a * t.n) // (x.f * y.f) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')
),
lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
absorbed AS (
    SELECT DISTINCT c.lang, c.phrase FROM counts c JOIN counts o
    ON o.lang = c.lang AND c.k > 1 AND o.k > c.k AND 100 * o.f >= 100 * c.f
       AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest ANTI JOIN absorbed USING (lang, phrase)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""

ORACLE["op12_adaptive_quality_rules"] = r"""
WITH split AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
runs AS (
    SELECT doc_id, unnest(range(1, len(w) - 6)) AS k, unnest(list_transform(range(1, len(w) - 6),
        lambda i: array_to_string(w[i:i + 7], ' '))) AS run
    FROM split WHERE len(w) >= 8
),
again AS (SELECT doc_id, k FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(k, k + 8)) AS place FROM again)
    GROUP BY doc_id
),
lines AS (
    SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x
    FROM split
),
measured AS (
    SELECT s.doc_id, s.lang, s.source, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines,
           coalesce(c.n, 0)::BIGINT AS n_repeat_words
    FROM split s JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)
),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured),
ruled AS (
    SELECT doc_id, lang, source, unnest([
        {'rule': 'word_length', 'v': 1000 * word_chars // n_words, 'least': 500},
        {'rule': 'symbols', 'v': 10000 * n_symbols // n_words, 'least': 1000},
        {'rule': 'repeated_lines', 'v': 10000 * n_dup_lines // n_words, 'least': 500},
        {'rule': 'repeated_words', 'v': 10000 * n_repeat_words // n_words, 'least': 2000}], recursive := true)
    FROM based WHERE NOT base_failed
),
cut AS (
    SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS value FROM ruled
),
groups AS (
    SELECT lang, source, 1 AS level, rule, least, value FROM cut
    UNION ALL SELECT lang, NULL, 2, rule, least, value FROM cut
    UNION ALL SELECT NULL, NULL, 3, rule, least, value FROM cut
),
quartiles AS (
    SELECT lang, source, level, rule, count(*) AS size, any_value(least) AS least,
           list_sort(list(value))[((count(*) + 3) // 4)::INTEGER] AS q1,
           list_sort(list(value))[((3 * count(*) + 3) // 4)::INTEGER] AS q3
    FROM groups GROUP BY lang, source, level, rule
),
limits AS (
    SELECT *, q1 - greatest(3 * (q3 - q1), least) AS low, q3 + greatest(3 * (q3 - q1), least) AS high FROM quartiles
),
judged AS (
    SELECT r.doc_id, bool_and(r.v BETWEEN
        CASE WHEN o.size >= 200 THEN o.low WHEN g.size >= 200 THEN g.low ELSE t.low END AND
        CASE WHEN o.size >= 200 THEN o.high WHEN g.size >= 200 THEN g.high ELSE t.high END) AS inside
    FROM ruled r
    JOIN limits o ON o.level = 1 AND o.rule = r.rule AND o.lang IS NOT DISTINCT FROM r.lang
        AND o.source IS NOT DISTINCT FROM r.source
    JOIN limits g ON g.level = 2 AND g.rule = r.rule AND g.lang IS NOT DISTINCT FROM r.lang
    JOIN limits t ON t.level = 3 AND t.rule = r.rule
    GROUP BY r.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM based LEFT JOIN judged USING (doc_id)
"""

ORACLE["op13_geometric_block_search"] = r"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
    FROM documents
),
tokens AS (SELECT doc_id, unnest(regexp_extract_all(x, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM lowered),
lengths AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term, docs
),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark
),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // len))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
