"""DuckDB SQL for the queries of ``catalog``: plain restatements, without the operators' methods."""

from __future__ import annotations

from tidemill.llm.licenses import BLOCK, PHRASES, STEP, template_sets
from tidemill.llm.pii import CUES, KEY_PREFIX

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


_CUE = "|".join(sorted({form for cue in CUES for form in (cue, cue.upper(), cue.capitalize())}))
_VALUE = "regexp_extract(v, '[:=#] ?([A-Za-z0-9-]+)$', 1)"
_DIGITS = "regexp_replace(v, '[ -]', '', 'g')"
_IBAN = r"""(regexp_full_match(value, '[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}') AND list_reduce(list_transform(string_split(
    array_to_string(list_transform(string_split(substr(value, 5) || substr(value, 1, 4), ''),
    lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), ''), ''),
    lambda c: TRY_CAST(c AS BIGINT)), lambda a, b: (a * 10 + b) % 97) = 1)"""
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "v", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "v",
     "list_max(list_transform(string_split(v, '.'), lambda p: coalesce(TRY_CAST(p AS HUGEINT), 1000))) <= 255"),
    ("card", r"[0-9]([\x20-]?[0-9])+", _DIGITS,
     """length(value) BETWEEN 13 AND 19 AND list_sum(list_transform(generate_series(1, length(value)), lambda i:
     CASE WHEN (length(value) - i) % 2 = 0 THEN CAST(value[i] AS BIGINT)
     ELSE (CAST(value[i] AS BIGINT) * 2) // 10 + (CAST(value[i] AS BIGINT) * 2) % 10 END)) % 10 = 0"""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "regexp_replace(v, '[^0-9]', '', 'g')", "length(value) BETWEEN 9 AND 15"),
    ("login", r"[A-Za-z0-9+.-]+://[^\x00-\x20/@]+@[A-Za-z0-9.-]+", "v", "true"),
    ("account", rf"(?:{_CUE})\x20?[:=#]\x20?[A-Za-z0-9-]+", _VALUE,
     f"CASE WHEN lower(v) LIKE 'iban%' THEN {_IBAN} ELSE length(value) BETWEEN 6 AND 34 AND regexp_matches(value, '[0-9]') END"),
    ("key", rf"{KEY_PREFIX}[A-Z0-9]*", "v", "length(value) = 20"),
]


def _kind(number: int, kind: str, pattern: str, value: str, good: str) -> str:
    # The value of a cue stands at the end of its match; all other spans are the match.
    begin = "b + length(v) - length(value)" if kind == "account" else "b"
    return f"""SELECT doc_id, {number} AS ord, '{kind}' AS kind, {begin} AS first, b + length(v) AS last FROM (
    SELECT doc_id, v, b, {value} AS value FROM (SELECT doc_id, ms[i] AS v,
    CAST(list_sum(list_transform(gaps[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda s: length(s))), 0) AS BIGINT) AS b
    FROM (SELECT doc_id, ms, gaps, unnest(generate_series(1, len(ms))) AS i FROM (
    SELECT doc_id, regexp_extract_all(x, '{pattern}') AS ms, string_split_regex(x, '{pattern}') AS gaps FROM t)))) WHERE {good}"""


PERSONAL_DATA = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
found AS ({' UNION ALL '.join(_kind(i, *k) for i, k in enumerate(_KINDS, 1))}),
named AS (SELECT *, kind || ':' || first || ':' || last AS span FROM found),
grouped AS (SELECT doc_id, string_agg(span, ',' ORDER BY ord, first) AS spans,
    string_agg(span, ',' ORDER BY ord, first) FILTER (ord <= 4) AS base,
    {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ('email', 'ip', 'card', 'phone'))} FROM named GROUP BY doc_id)
SELECT t.doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ('email', 'ip', 'card', 'phone'))},
sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN grouped ON t.doc_id = grouped.doc_id"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _places(phrase: str) -> str:
    own = phrase.split()
    return f"list_filter(generate_series(1, len(w) - {len(own) - 1}), lambda i: w[i:i + {len(own) - 1}] = {_list(own)})"


_TEMPLATES = ", ".join(f"('{label}', {_list(own)}, {least})" for label, own, least in template_sets())
LICENSES = f"""WITH t AS (SELECT doc_id, regexp_extract_all({_lowered('text')}, '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, w, {', '.join(f"{_places(phrase)} AS p{i}" for i, phrase in enumerate(PHRASES.values()))} FROM t),
q AS (SELECT *, {' || '.join(f'p{i}' for i in range(len(PHRASES)))} AS places,
    {' || '.join(f"CASE WHEN len(p{i}) > 0 THEN ['{label}'] ELSE [] END" for i, label in enumerate(PHRASES))} AS phrases FROM p),
templates(label, own, least) AS (VALUES {_TEMPLATES}),
blocks AS (SELECT doc_id, list_distinct(w[b * {STEP} + 1:b * {STEP} + {BLOCK}]) AS block FROM (
    SELECT doc_id, w, unnest(generate_series(0, greatest(0, CAST(ceil((len(w) - {BLOCK}) / {STEP}.0) AS BIGINT)))) AS b FROM t WHERE len(w) > 0)),
met AS (SELECT doc_id, label, len(list_intersect(block, own)) AS n, len(own) AS size, least FROM blocks, templates),
found AS (SELECT doc_id, list(DISTINCT label) AS more, max(n / size) AS best FROM met WHERE n >= least GROUP BY doc_id)
SELECT q.doc_id, len(w) AS n_words, len(places) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
array_to_string(list_sort(phrases), ',') AS base_labels,
array_to_string(list_sort(list_distinct(phrases || coalesce(more, []))), ',') AS labels,
CAST(CASE WHEN len(places) > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM q LEFT JOIN found ON q.doc_id = found.doc_id"""

LINE_DEDUP = f"""WITH l AS (SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first <> doc_id) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id"""

NEAR_DUPLICATES = rf"""WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all({_lowered('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (
    SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON c.doc_id = n.doc_id"""

DECONTAMINATION = f"""WITH b AS (SELECT item_id, w, least(10, len(w)) AS k FROM (
    SELECT item_id, regexp_extract_all({_lowered('text')}, '{WORD}') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
    SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM b)),
t AS (SELECT doc_id, regexp_extract_all({_lowered('text')}, '{WORD}') AS w FROM documents),
grams AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM (
    SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM t, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
met AS (SELECT doc_id, item_id, g.k, i FROM grams g JOIN windows v ON g.k = v.k AND g.win = v.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN hits ON t.doc_id = hits.doc_id LEFT JOIN items ON t.doc_id = items.doc_id"""

WARC = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f ON p.d = f.d"""

EXACT_DUPLICATES = """WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g ON t.x = g.x"""

REPEATED_WINDOWS = r"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS win FROM (
    SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM t WHERE len(w) >= 50)),
f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i FROM g JOIN f ON g.win = f.win WHERE doc_id > first),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM t WHERE len(w) > 0),
kept AS (SELECT words.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS x
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id"""

# crc32 bit by bit; the value at the end is still to be inverted.
_CRC32 = """list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END, CAST(4294967295 AS BIGINT))"""
PERIODIC_RUNS = rf"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, 4294967295 - {_CRC32} AS h FROM documents),
b AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
c AS (SELECT *, 1 + (len(w) - a) // (3 + (h // 10) % 8) AS p FROM b),
word AS (SELECT doc_id, i, CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word FROM (
    SELECT doc_id, w, a, p, unnest(generate_series(0, len(w) - 1)) AS i FROM c WHERE len(w) > 0)),
texts AS (SELECT doc_id, list(word ORDER BY i) AS w FROM word GROUP BY doc_id),
gram AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS g FROM (
    SELECT doc_id, w, unnest(generate_series(0, len(w) - 6)) AS i FROM texts WHERE len(w) >= 12)),
met AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
island AS (SELECT doc_id, q, min(i) AS s, max(i) - min(i) + 6 AS m FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM met) GROUP BY doc_id, q, part),
long AS (SELECT doc_id, s, m + q AS l, q FROM island WHERE m + q >= greatest(12, 2 * q)),
run AS (SELECT * FROM long x WHERE NOT EXISTS (SELECT 1 FROM long y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
named AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS names,
    first(s ORDER BY l DESC, s, q) AS start, max(l) AS length, first(q ORDER BY l DESC, s, q) AS period FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s + q, s + l - 1)) AS i FROM run),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS x
    FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY word.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
sha256(coalesce(names, '')) AS runs_sha256, sha256(coalesce(x, '')) AS collapsed_sha256
FROM t LEFT JOIN named ON t.doc_id = named.doc_id LEFT JOIN kept ON t.doc_id = kept.doc_id"""

COLLOCATIONS = rf"""WITH t AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, string_split_regex({_lowered('text')}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS piece FROM t)),
g AS (SELECT lang, k, w[i:i + k - 1] AS ws FROM (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM p, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, array_to_string(ws, ' ') AS phrase, ws, count(*) AS f FROM g GROUP BY lang, k, ws),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT lang, k, phrase, f AS a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS rest FROM (
    SELECT *, unnest(generate_series(1, k - 1)) AS j FROM c)),
scored AS (SELECT cut.*, x.f AS l, y.f AS r, (1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, inner_phrase, max(f) AS longest FROM (
    SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS inner_phrase FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN longer ON best.lang = longer.lang AND best.phrase = inner_phrase AND k = 2
    WHERE longest IS NULL OR 100 * longest < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN n ON kept.lang = n.lang QUALIFY rank <= 2000"""
