"""DuckDB SQL for the registered queries."""

from tickloom.llm import licenses

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations),
convs AS (
  SELECT conv_id, count(*) AS n_turns, list(struct_pack(r := role, t := text) ORDER BY pos) AS turns FROM turns GROUP BY conv_id),
ends AS (
  SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS n_logged FROM convs GROUP BY turns, n_turns),
kept AS (
  SELECT * FROM ends a WHERE NOT EXISTS (
    SELECT 1 FROM ends b WHERE b.n_turns > a.n_turns AND list_slice(b.turns, 1, a.n_turns) = a.turns))
SELECT k.conv_id, (t.pos - 1) // 1024 AS part, k.n_turns, k.n_logged,
  string_agg('<|im_start|>' || replace(coalesce(t.role, 'unknown'), '<|', '< |') || chr(10)
    || replace(coalesce(t.text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY t.pos) AS text
FROM kept k JOIN turns t ON t.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY ALL
"""

RULES_CTE = r"""
body AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT rid, doc_id, t, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM body),
grams AS (
  SELECT rid, i, w[i : i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
measures AS (
  SELECT s.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.rid = s.rid),
ledger AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS failure_bits
  FROM measures)"""

OP3 = f"""
WITH {RULES_CTE}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, n_lines, failure_bits
FROM ledger
"""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight FROM sources),
ranked AS (
  SELECT *, CAST(CAST(sum(source_size) OVER () AS BIGINT)
      - coalesce(CAST(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level,
    3 * source_size / weight AS ratio
  FROM weighed WINDOW w AS (ORDER BY 3 * source_size / weight, source IS NULL, encode(source))),
chosen AS (SELECT level FROM ranked WHERE level * weight <= 3 * source_size ORDER BY ratio LIMIT 1),
goals AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), chosen.level * weight) AS target FROM ranked, chosen),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
    CAST(coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CASE WHEN g.source_size > 0 THEN CAST(floor(g.target) AS BIGINT) // g.source_size ELSE 0 END AS epochs
  FROM sized s JOIN goals g ON g.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM placed
"""

_TOKENS = r"""[x FOR x IN regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')]"""

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TOKENS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TOKENS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, w[k : k + least(len(w), 10) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT rid, k, n, w[k : k + n - 1] AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, k, i.n, item FROM doc_windows dw JOIN item_windows i ON i.n = dw.n AND i.g = dw.g),
hit_words AS (
  SELECT rid, count(DISTINCT k + o) AS n_hit FROM (SELECT rid, k, unnest(range(0, n)) AS o FROM hits) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

OP5 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, w[i : i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM words WHERE len(w) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
rare AS (
  SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS place
  FROM sets JOIN (SELECT g, count(*) AS f FROM sets GROUP BY g) USING (g)),
heads AS (SELECT doc_id, g FROM rare JOIN sizes USING (doc_id) WHERE place <= n - ceil(0.8 * n) + 1),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM heads a JOIN heads b ON a.g = b.g AND a.doc_id < b.doc_id),
shared AS (
  SELECT p.a, p.b, count(*) AS n FROM pairs p JOIN sets x ON x.doc_id = p.a JOIN sets y ON y.doc_id = p.b AND y.g = x.g GROUP BY p.a, p.b),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id,
  coalesce(l.component_id, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN least l ON l.doc_id = w.doc_id
"""

OP6 = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
lines AS (
  SELECT doc_id, line, w, len(w) AS n, md5(array_to_string(w, ' ')) AS full_key FROM (
    SELECT doc_id, line, regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM split) WHERE len(w) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY full_key ORDER BY doc_id, line) AS copy FROM lines),
firsts AS (SELECT doc_id, line, w, n, full_key FROM ranked WHERE copy = 1 AND n >= 8),
variants AS (
  SELECT doc_id, line, n, i, md5(array_to_string(list_concat(w[1 : i - 1], w[i + 1 : n]), ' ')) AS key
  FROM (SELECT doc_id, line, w, n, unnest(range(1, n + 1)) AS i FROM firsts)),
pairs AS (
  SELECT a.doc_id AS d1, a.line AS l1, b.doc_id AS d2, b.line AS l2 FROM variants a JOIN variants b ON a.key = b.key AND a.i = b.i AND a.n = b.n
  UNION ALL SELECT v.doc_id, v.line, f.doc_id, f.line FROM variants v JOIN firsts f ON f.full_key = v.key
  UNION ALL SELECT f.doc_id, f.line, v.doc_id, v.line FROM variants v JOIN firsts f ON f.full_key = v.key),
near AS (SELECT DISTINCT d1 AS doc_id, l1 AS line FROM pairs WHERE (d2, l2) < (d1, l1)),
verdicts AS (
  SELECT r.doc_id, r.copy > 1 AS equal, n.line IS NOT NULL AS near
  FROM ranked r LEFT JOIN near n ON n.doc_id = r.doc_id AND n.line = r.line),
counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE equal) AS n_equal, count(*) FILTER (WHERE NOT equal AND near) AS n_near
  FROM verdicts GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near,
  coalesce(n_lines - n_equal - n_near, 0) AS n_kept
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN counts c ON c.doc_id = d.doc_id
"""

# Texts as hex, two characters a byte, so that strings of bytes are substrings.
OP10 = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM texts WHERE n >= 50),
windows AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 100)) AS g FROM starts),
removed AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE first < doc_id),
spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (
    SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS part FROM (
      SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS opens FROM removed))
  GROUP BY doc_id, part),
gaps AS (
  SELECT s.doc_id, substr(h, 2 * CAST(coalesce(lag(b) OVER w, 0) AS BIGINT) + 1, 2 * CAST(a - coalesce(lag(b) OVER w, 0) AS BIGINT)) AS piece, a
  FROM spans s JOIN texts t ON t.doc_id = s.doc_id WINDOW w AS (PARTITION BY s.doc_id ORDER BY a)),
sums AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS body FROM gaps GROUP BY doc_id)
SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN h ELSE body || substr(h, 2 * CAST(last AS BIGINT) + 1) END)) AS kept_sha256
FROM texts t LEFT JOIN sums s ON s.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
"""

_TEMPLATES = ", ".join(
    f"({number}, '{t.label}', {t.phrase}, {t.gram}, {t.band}, {t.needed}, string_split('{b' '.join(t.words).decode()}', ' '))"
    for number, t in enumerate(licenses.templates_of())
)

OP12 = f"""
WITH t(template, label, phrase, k, band, needed, tw) AS (VALUES {_TEMPLATES}),
places AS (SELECT *, tw[p + 1 : p + k] AS g FROM (SELECT *, unnest(range(0, len(tw) - k + 1)) AS p FROM t)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_TOKENS} AS w FROM documents),
grams AS (
  SELECT rid, k, i, w[i + 1 : i + k] AS g
  FROM (SELECT rid, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM t) WHERE len(w) >= k)),
votes AS (
  SELECT rid, template, i - p AS diagonal, count(*) AS votes, min(i) AS a, max(i) + any_value(p.k) AS b, any_value(band) AS band, any_value(needed) AS needed
  FROM grams g JOIN places p ON p.k = g.k AND p.g = g.g GROUP BY rid, template, i - p),
apart AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) > band THEN 1 ELSE 0 END AS apart FROM votes),
runs AS (SELECT *, sum(apart) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run FROM apart),
spans AS (
  SELECT rid, template, run, min(a) AS a, max(b) AS b, list(diagonal) AS diagonals FROM runs
  GROUP BY rid, template, run HAVING sum(votes) >= any_value(needed)),
compared AS (
  SELECT rid, template, run, a, b, p, p + dg AS at FROM (
    SELECT s.*, dg, unnest(range(0, len(tw))) AS p, tw FROM (SELECT *, unnest(diagonals) AS dg FROM spans) s JOIN t USING (template))
  WHERE p + dg >= a AND p + dg < b),
verified AS (
  SELECT c.rid, c.template, run, any_value(label) AS label, any_value(phrase) AS phrase, any_value(a) AS a, any_value(len(tw)) AS n,
    greatest(any_value(len(tw)), any_value(b - a)) AS size, count(DISTINCT c.p) AS matched
  FROM compared c JOIN d ON d.rid = c.rid JOIN t ON t.template = c.template AND d.w[c.at + 1] = t.tw[c.p + 1] GROUP BY c.rid, c.template, run),
judged AS (SELECT *, CASE WHEN phrase THEN matched = size ELSE 10 * matched >= {licenses.AGREE} * size END AS good FROM verified WHERE matched = n OR NOT phrase),
digest AS (
  SELECT rid, count(*) FILTER (phrase) AS n_base, min(a) FILTER (phrase) AS first_word, max(a) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels,
    max(CAST(matched AS DOUBLE) / CAST(size AS DOUBLE)) AS score, count(*) FILTER (good) AS n_spans
  FROM judged GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0.0) AS score, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN digest USING (rid)
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {terms} AS w FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, {terms} AS w FROM benchmark),
lengths AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (SELECT iid, item_id, term, count(*) AS times FROM (SELECT iid, item_id, unnest(w) AS term FROM i) GROUP BY iid, item_id, term),
weighed AS (
  SELECT iid, item_id, term, times * CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM wanted JOIN df USING (term), corpus),
scored AS (
  SELECT iid, item_id, doc_id, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN lengths USING (rid), corpus GROUP BY iid, item_id, doc_id, rid),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
""".replace("{terms}", _TOKENS)
