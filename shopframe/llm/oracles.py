"""DuckDB SQL for the operators that SQL can express, written from their definitions.

Each statement numbers the rows first, so that repeated rows stay apart.
"""

from __future__ import annotations

from . import secrets

W = r"[^\x20\x09-\x0D]+"
WORDS = f"regexp_extract_all(COALESCE(text, ''), '{W}')"
LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def repeated_words(width: int = 35) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - {width - 2})) AS i, unnest(list_transform(range(1, len(w) - {width - 2}), lambda i: md5(array_to_string(w[i:i + {width - 1}], ' ')))) AS g FROM d),
twice AS (SELECT r, i FROM win SEMI JOIN (SELECT g FROM win GROUP BY g HAVING COUNT(*) > 1) t USING (g)),
gone AS (SELECT DISTINCT r, i + o AS i FROM twice, range({width}) x(o)),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, (SELECT COUNT(*) FROM gone g WHERE g.r = d.r) AS n_removed, sha256(COALESCE(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def repeated_bytes(width: int = 400) -> str:
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(COALESCE(text, '')) AS b, hex(encode(COALESCE(text, ''))) AS h FROM documents),
win AS (SELECT r, unnest(range(1, octet_length(b) - {width - 2})) AS i, unnest(list_transform(range(1, octet_length(b) - {width - 2}), lambda i: md5(array_slice(b, i, i + {width - 1})))) AS g FROM d),
twice AS (SELECT r, i FROM win SEMI JOIN (SELECT g FROM win GROUP BY g HAVING COUNT(*) > 1) t USING (g)),
-- runs of windows whose starts are at most a window apart
run AS (SELECT r, MIN(i) AS a, MAX(i) + {width} AS b FROM (
  SELECT r, i, SUM(fresh) OVER (PARTITION BY r ORDER BY i) AS n FROM (
    SELECT r, i, COALESCE(CAST(i - LAG(i) OVER (PARTITION BY r ORDER BY i) > {width} AS INTEGER), 1) AS fresh FROM twice)) GROUP BY r, n),
edge AS (SELECT r, a, b, LAG(b, 1, 1) OVER (PARTITION BY r ORDER BY a) AS since FROM run),
left_over AS (SELECT d.r, string_agg(substr(d.h, 2 * e.since - 1, 2 * (e.a - e.since)), '' ORDER BY e.a) || substr(ANY_VALUE(d.h), 2 * MAX(e.b) - 1) AS h,
              SUM(e.b - e.a) AS gone, COUNT(*) AS spans FROM d JOIN edge e USING (r) GROUP BY d.r)
SELECT d.doc_id, octet_length(d.b) AS n_bytes, CAST(COALESCE(l.gone, 0) AS BIGINT) AS n_removed, COALESCE(l.spans, 0) AS n_spans,
       sha256(unhex(COALESCE(l.h, d.h))) AS kept_sha256
FROM d LEFT JOIN left_over l USING (r)"""


MIX = f"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
s AS (SELECT source, SUM(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
c AS (SELECT *, [5.0, 2.0, 1.0][(n - 1) % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size::DOUBLE AS cap FROM s),
-- the level is the highest of those that are left after filling the first k sources
lev AS (SELECT (SUM(cap) OVER () / 3 - SUM(cap) OVER o) / (SUM(w) OVER () - SUM(w) OVER o) AS l FROM c
        WINDOW o AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
top AS (SELECT GREATEST(MAX(l), (SELECT SUM(cap) / 3 / SUM(w) FROM c)) AS l FROM lev),
t AS (SELECT c.*, LEAST(cap, top.l * w) AS target FROM c, top),
k AS (SELECT t.*, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, CAST(k.source_size AS BIGINT) AS source_size, k.target, d.size * CAST(FLOOR(rate)
  + CAST(('0x' || substr(md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT / 281474976710656.0 < rate - FLOOR(rate) AS INTEGER) AS BIGINT) AS taken
FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source"""

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, COALESCE(text, '') AS t, {WORDS} AS w FROM documents),
line AS (SELECT r, source, t, trim(regexp_replace({LOW.format('x')}, '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS x, len(regexp_extract_all(x, '{W}')) AS n
         FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{W}')),
hosts AS (SELECT source, COUNT(DISTINCT t) AS docs FROM d GROUP BY source),
often AS (SELECT l.source, l.x FROM line l JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source GROUP BY l.source, l.x, h.docs
          HAVING COUNT(DISTINCT l.t) > 20 AND COUNT(DISTINCT l.t) > 0.01 * h.docs),
lost AS (SELECT l.r, SUM(l.n) AS n FROM line l JOIN often o ON o.x = l.x AND o.source IS NOT DISTINCT FROM l.source GROUP BY l.r),
tri AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM d),
again AS (SELECT r, COUNT(DISTINCT i + o) AS n FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, g) AS c FROM tri), range(3) x(o) WHERE c > 1 GROUP BY r),
same AS (SELECT r, COUNT(*) - COUNT(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{W}') GROUP BY r),
c AS (SELECT d.r, d.doc_id, len(d.w) AS n_words, length(array_to_string(d.w, '')) AS word_chars, length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      COALESCE(same.n, 0) AS n_dup_lines, COALESCE(again.n, 0) AS n_repeat_words, CAST(COALESCE(lost.n, 0) AS BIGINT) AS n_removed_words
      FROM d LEFT JOIN same USING (r) LEFT JOIN again USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words,
       n_words < 50 OR 2 * n_repeat_words > n_words AS base_failed, NOT (n_words < 50 OR 2 * n_repeat_words > n_words) AND 2 * n_removed_words <= n_words AS kept
FROM c"""


def _kind(n: int, name: str) -> str:
    pattern, group, least = (secrets.BASE | secrets.MORE)[name]
    q = pattern.replace("'", "''")
    return f"""SELECT r, source, t, {n} AS kind, s, s + length(m[i]) AS e, v[i] AS v FROM (
    SELECT *, COALESCE(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, source, t, regexp_extract_all(t, '{q}') AS m, regexp_extract_all(t, '{q}', {group}) AS v, string_split_regex(t, '{q}') AS p FROM d WHERE regexp_matches(t, '{q}'))))
  WHERE length(v[i]) >= {least}"""


_NAMES = ", ".join(f"'{k}'" for k in secrets.KINDS)
SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, COALESCE(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_kind(i, k) for i, k in enumerate(secrets.KINDS))}),
good AS (SELECT *, NOT regexp_matches({LOW.format('v')}, '{secrets.PLACEHOLDER}') AND len(list_distinct(string_split(v, ''))) >= 6
    AND (kind <> {secrets.KINDS.index("mixed")} OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]'))) AS good FROM found),
looks AS (SELECT g.* FROM good g WHERE kind < {len(secrets.BASE)} OR (good AND NOT EXISTS (SELECT 1 FROM found b WHERE b.r = g.r AND b.kind < g.kind AND g.s < b.e AND b.s < g.e))),
-- texts that a source holds, and the smallest source of each text
most AS (SELECT v, MAX(n) AS most FROM (SELECT v, source, COUNT(DISTINCT t) AS n FROM looks GROUP BY v, source) GROUP BY v),
repo AS (SELECT v, t, MIN(source) AS source FROM looks GROUP BY v, t),
freq AS (SELECT v, COUNT(*) AS repos, CASE WHEN MAX(most) = COUNT(*) THEN 1 ELSE COUNT(DISTINCT COALESCE('o' || source, '')) END AS owners FROM repo JOIN most USING (v) GROUP BY v),
span AS (SELECT r, kind, s, e, owners, repos, good AND owners <= 1 AS live, [{_NAMES}][kind + 1] || ':' || s || ':' || e AS x FROM looks JOIN freq USING (v) WHERE kind < {len(secrets.BASE)} OR owners <= 1),
doc AS (SELECT r, {", ".join(f"COUNT(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(secrets.BASE))},
        string_agg(x, ',' ORDER BY s, kind) FILTER (WHERE kind < {len(secrets.BASE)}) AS base,
        {", ".join(f"string_agg(CAST({c} AS VARCHAR), ',' ORDER BY s, e, kind) AS {n}" for c, n in (("x", "spans"), ("owners", "owners"), ("repos", "repositories"), ("live", "live")))} FROM span GROUP BY r)
SELECT d.doc_id, {", ".join(f"COALESCE(n_{k}, 0) AS n_{k}" for k in secrets.BASE)}, sha256(COALESCE(base, '')) AS base_sha256,
       {", ".join(f"COALESCE({n}, '') AS {n}" for n in ("spans", "owners", "repositories", "live"))}
FROM d LEFT JOIN doc USING (r)"""

VECTORS = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT * FROM d WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(v, lambda x: abs(x))) > 0),
link AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT reach.a AS r, MIN(d.vec_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT d.vec_id, (SELECT COUNT(*) FROM link WHERE link.a = d.r) AS n_links, comp.component_id, d.vec_id IS NOT DISTINCT FROM comp.component_id AS kept
FROM d JOIN comp USING (r)"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOW.format("COALESCE(text, '')")}, '{W}') AS w FROM documents),
sh AS (SELECT DISTINCT r, unnest(list_transform(range(1, GREATEST(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM d WHERE len(w) > 0),
size AS (SELECT r, COUNT(*) AS n FROM sh GROUP BY r),
both_in AS (SELECT x.r AS a, y.r AS b, COUNT(*) AS n FROM sh x JOIN sh y ON x.g = y.g AND x.r <> y.r GROUP BY ALL),
link AS (SELECT a, b FROM both_in i JOIN size p ON p.r = a JOIN size q ON q.r = b WHERE 100 * i.n >= 75 * (p.n + q.n - i.n)),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT reach.a AS r, MIN(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
SELECT d.doc_id, COALESCE(size.n, 0) AS n_shingles, comp.component_id, d.doc_id IS NOT DISTINCT FROM comp.component_id AS kept
FROM d JOIN comp USING (r) LEFT JOIN size USING (r)"""

PHRASES = f"""
WITH piece AS (SELECT lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w FROM (
  SELECT COALESCE(lang, 'und') AS lang, unnest(regexp_split_to_array({LOW.format("COALESCE(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents)),
total AS (SELECT lang, SUM(len(w)) AS n FROM piece GROUP BY lang),
f AS (SELECT lang, k, g, COUNT(*) AS a FROM (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM piece, range(1, 6) x(k)) GROUP BY ALL HAVING COUNT(*) >= 100),
c AS (SELECT *, string_split(g, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, g, a, w, unnest(range(1, k)) AS h FROM c),
scored AS (SELECT cut.lang, cut.g, cut.a, h, l.a AS l, r.a AS r, (1000::HUGEINT * cut.a * total.n) // (l.a::HUGEINT * r.a) AS score FROM cut JOIN total USING (lang)
  JOIN f l ON l.lang = cut.lang AND l.g = array_to_string(cut.w[1:h], ' ') JOIN f r ON r.lang = cut.lang AND r.g = array_to_string(cut.w[h + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, h) = 1),
absorbed AS (SELECT DISTINCT c.lang, c.g FROM c JOIN c b ON b.lang = c.lang AND b.k > c.k AND 100 * b.a >= 100 * c.a AND contains(' ' || b.g || ' ', ' ' || c.g || ' ')),
ranked AS (SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM best ANTI JOIN absorbed USING (lang, g))
SELECT lang, rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

RUNS = f"""
WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
id AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
h AS (SELECT r, doc_id, w, len(w) AS n, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM id, tab),
p AS (SELECT r, doc_id, w, n, h % 10 = 0 AS planted, (h // 10) % GREATEST(n, 1) AS a, 1 + (n - (h // 10) % GREATEST(n, 1)) // (3 + (h // 10) % 8) AS p FROM h),
d AS (SELECT r, doc_id, n, CASE WHEN planted AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w FROM p),
word AS (SELECT r, n, unnest(range(n)) AS i, unnest(w) AS x FROM d),
same AS (SELECT x.r, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.r = y.r AND x.x = y.x AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
-- consecutive words that equal the word q later
stretch AS (SELECT r, q, MIN(i) AS s, COUNT(*) + q AS len FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same) GROUP BY r, q, island HAVING COUNT(*) + q >= GREATEST(6, 4 * q)),
run AS (SELECT r, s, len, MIN(q) AS q FROM stretch GROUP BY r, s, len),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r),
longest AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY r ORDER BY len DESC, s, q) = 1),
listed AS (SELECT r, COUNT(*) AS n, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY r)
SELECT doc_id, COALESCE(listed.n, 0) AS n_runs, s AS "start", len AS "length", longest.q AS "period", 1000 * len // longest.q AS exponent_milli,
       sha256(COALESCE(listed.t, '')) AS runs_sha256, sha256(COALESCE(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r) LEFT JOIN longest USING (r)"""

ORACLES = {
    "op2_fm_index": repeated_words(),
    "op3_mixing": MIX,
    "op4_suffix_array": repeated_bytes(),
    "op7_quality_rules": QUALITY,
    "op8_secret_scan": SECRETS,
    "op9_embedding_forest": VECTORS,
    "op10_superminhash": NEAR,
    "op11_collocations": PHRASES,
    "op13_periodic_runs": RUNS,
}
