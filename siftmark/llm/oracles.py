"""DuckDB SQL for the queries that it can express.

Scores of hashed n-grams (op1), compression (op2), tokenizers (op7, op8) and automata with learned
weights (op10) and models (op11) have none; their tests compare with brute force, the library or held-out labels.
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{LETTERS}') w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{LETTERS}') w FROM benchmark),
items AS (SELECT DISTINCT item, least(10, len(w)) n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') g
    FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) p FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM items),
found AS (SELECT doc_id, p, n, item FROM
    (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') g FROM
        (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) p FROM d, sizes WHERE len(w) >= n))
    JOIN items USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT h) n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) h FROM found) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) s FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(s, '')) items_sha256,
    coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP4 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) no FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) i FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
p AS (SELECT doc_id, no, i, line, lead(line) OVER w nxt, lead(no) OVER w no2 FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY no)),
r AS (SELECT *, row_number() OVER (PARTITION BY line, nxt ORDER BY doc_id, i) k FROM p WHERE nxt IS NOT NULL),
g AS (SELECT doc_id, no FROM r WHERE k > 1 UNION SELECT doc_id, no2 FROM r WHERE k > 1)
SELECT doc_id, count(*) n_lines, count(g.no) n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY l.no) FILTER (g.no IS NULL), '')) kept_sha256
FROM l LEFT JOIN g USING (doc_id, no) GROUP BY doc_id
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{PLAIN}') w FROM documents),
win AS (SELECT doc_id, p, array_to_string(w[p:p + 19], ' ') g FROM
    (SELECT doc_id, w, unnest(range(1, len(w) - 18)) p FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) k FROM later),
words AS (SELECT doc_id, unnest(w) word, generate_subscripts(w, 1) k FROM d),
kept AS (SELECT doc_id, count(g.k) n_removed, string_agg(word, ' ' ORDER BY words.k) FILTER (g.k IS NULL) s
    FROM words LEFT JOIN gone g ON g.doc_id = words.doc_id AND g.k = words.k GROUP BY words.doc_id)
SELECT doc_id, len(w) n_words, coalesce(n_removed, 0) n_removed, sha256(coalesce(s, '')) kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
""".replace("kept AS (SELECT doc_id,", "kept AS (SELECT words.doc_id,")

OP6 = r"""
WITH u AS (SELECT page_id, coalesce(url, '') url FROM pages),
h AS (SELECT page_id, translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/' END rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END verdict FROM r
"""

OP9 = rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{PLAIN}') w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') g FROM
    (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
pairs AS MATERIALIZED (SELECT a.doc_id x, b.doc_id y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON reach.y = pairs.x)
SELECT d.doc_id, coalesce(n.n, 0) n_shingles, c.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

# crc32 by its definition: eight steps for each of 256 entries, then one look-up a byte.
OP12 = rf"""
WITH RECURSIVE steps(i, k, c) AS (SELECT range, 0, range FROM range(256)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) tab FROM steps WHERE k = 8),
runs AS (SELECT doc_id, {LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} run FROM documents),
long AS (SELECT doc_id, run, count(*) times, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) x FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, times, xor(4294967295, list_reduce(
    list_prepend(4294967295, [CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) FOR i IN range(0, length(x) // 2)]),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) h FROM long, crc),
typed AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END word, times FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) rest FROM (SELECT word, unnest(range(1, length(word) + 1)) i FROM v)),
near AS (SELECT a.word, b.word other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
    UNION SELECT a.word, b.word FROM cut a JOIN v b ON a.rest = b.word UNION SELECT b.word, a.word FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT near.word, count(*) n_near, arg_min(other, row(-v.n, other)) form, max(v.n) form_n FROM near JOIN v ON v.word = near.other GROUP BY near.word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) n_near, CASE WHEN form_n >= 5 * v.n THEN form END form,
    CASE WHEN form_n >= 5 * v.n THEN form_n END form_n FROM v LEFT JOIN best USING (word)),
chain(word, tip) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.tip WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.tip root, f.n, f.n_near, f.form_n FROM f JOIN chain ON chain.word = f.word JOIN f e ON e.word = chain.tip AND e.form IS NULL
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{TERMS}') w FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{TERMS}')) term FROM benchmark),
tf AS MATERIALIZED (SELECT r, doc_id, term, len(w) n, count(*) tf FROM (SELECT r, doc_id, w, unnest(w) term FROM d) GROUP BY ALL),
total AS (SELECT count(*) docs, CAST(sum(len(w)) AS BIGINT) terms FROM d WHERE len(w) > 0),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) weight FROM tf, total GROUP BY term, docs),
part AS (SELECT tf.r, tf.doc_id, tf.term, weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) part
    FROM tf JOIN weight USING (term), total),
s AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) score FROM b JOIN part USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) rank FROM s)
SELECT item_id, CAST(rank AS INT) rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_decontaminate": OP3,
    "op4_line_dedup": OP4,
    "op5_substring_dedup": OP5,
    "op6_url_filter": OP6,
    "op9_jaccard_join": OP9,
    "op12_spelling_variants": OP12,
    "op13_lexical_search": OP13,
}
