"""DuckDB twins of the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from linfold.llm import chat, linededup, mixing, rules, substring, suffix

_WORD = r"'[^\x20\x09-\x0D]+'"
_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DOCS = f"d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, " \
        f"regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents)"


def minhash_sql() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w
                     FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [w[i:i + 4] FOR i IN range(1, len(w) - 3)]
                                         WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id"""


def mixing_sql() -> str:
    at = f"CAST(ceil((1 - ({{0}} - floor({{0}}))) * {mixing.OFFSETS} - u) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size FROM documents),
s AS (SELECT source, coalesce('s' || source, 'n') AS key, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS DOUBLE) AS weight FROM s),
l AS (SELECT *, source_size * 3.0::DOUBLE / weight AS ratio, source_size * 3.0::DOUBLE AS cap FROM w),
v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))
        AS level FROM l WINDOW b AS (ORDER BY ratio, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
o AS (SELECT min(ratio) AS ratio FROM v WHERE ratio > level),
g AS (SELECT key, source_size, CASE WHEN ratio <= level THEN cap
        ELSE weight * (SELECT arg_min(level, (ratio, key)) FROM v WHERE ratio > level) END AS target,
        (('0x' || substr(md5('11|' || key), 1, 5))::BIGINT + 0.5::DOUBLE) / {mixing.STEPS} AS u FROM v),
k AS (SELECT d.*, g.*, row_number() OVER (PARTITION BY g.key ORDER BY size, doc_id) - 1 AS r,
        CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM d JOIN g ON g.key = coalesce('s' || d.source, 'n')),
x AS (SELECT *, r * rate AS x1, (r + 1) * rate AS x2 FROM k),
c AS (SELECT *, CAST(floor(x2) - floor(x1) AS BIGINT) AS whole, {at.format("x2")} AS more, {at.format("x1")} AS less FROM x),
i AS (SELECT key, target, 0 AS b, whole * size AS d FROM c UNION ALL SELECT key, target, more, size FROM c
      UNION ALL SELECT key, target, less, -size FROM c),
t AS (SELECT key, target, b, sum(d) AS d FROM i WHERE b < {mixing.OFFSETS} GROUP BY ALL),
m AS (SELECT key, b, abs(sum(d) OVER (PARTITION BY key ORDER BY b) - target) AS miss FROM t),
b AS (SELECT key, arg_min(b, (miss, b)) AS b FROM m GROUP BY key),
z AS (SELECT c.*, whole + CAST(b.b >= more AS BIGINT) - CAST(b.b >= less AS BIGINT) AS copies FROM c JOIN b ON b.key = c.key)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM z"""


def linededup_sql() -> str:
    key = _ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, {key} AS key FROM l),
h AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {linededup.MIN_CHARS} GROUP BY key
      HAVING count(DISTINCT r) >= {linededup.MIN_DOCS}),
m AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id IS DISTINCT FROM h.keeper AS gone FROM k LEFT JOIN h ON h.key = k.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""


def rules_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
    tests = []
    for _, top, bottom, least, most in rules.RULES:
        value = f"CASE WHEN {bottom} = 0 THEN 0 ELSE {top}::DOUBLE / {bottom} END" if bottom else f"{top}::DOUBLE"
        if least is not None:
            tests.append(f"{value} >= {least}::DOUBLE")
        if most is not None:
            tests.append(f"{value} <= {most}::DOUBLE")
    failed = f"(n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words)"
    return f"""
WITH {_DOCS},
tri AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS g FROM d WHERE len(w) > 2),
twice AS (SELECT r, i FROM tri QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, {_WORD})] AS l FROM d),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(len([x FOR x IN w IF lower(x) IN ({stops})]) AS BIGINT) AS n_stop_words,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d JOIN lines ON lines.r = d.r LEFT JOIN rep ON rep.r = d.r)
SELECT *, {failed} AS base_failed, NOT {failed} AND {' AND '.join(tests)} AS kept FROM m"""


def warc_sql() -> str:
    return """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM h)
SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((('0x' || substr(x, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)
         FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""


def substring_sql() -> str:
    n = substring.WINDOW
    return f"""
WITH {_DOCS},
g AS (SELECT r, unnest(range(1, len(w) - {n - 2})) AS i,
        unnest([array_to_string(w[i:i + {n - 1}], ' ') FOR i IN range(1, len(w) - {n - 2})]) AS k FROM d WHERE len(w) >= {n}),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {n})) AS i FROM twice),
u AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
k AS (SELECT u.r, string_agg(u.x, ' ' ORDER BY u.i) AS kept, count(*) AS n FROM u ANTI JOIN gone ON gone.r = u.r AND gone.i = u.i GROUP BY u.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.r = d.r"""


def chat_sql() -> str:
    tokens = f"len(regexp_extract_all(t, {_WORD})) + {chat.MARK_TOKENS}"
    esc = r"replace(replace(replace({0}, '\', '\\'), '#', '\h'), '<', '\l')"
    role = r"replace(" + esc.format("ro") + r", ':', '\c')"
    near = " UNION ALL ".join(f"""
SELECT conv_id, chars FROM (SELECT *, lead(opens, {j}) OVER o AS o2, lead(e, {j}) OVER o - lead(k, {j}) OVER o - (e - k) AS gap
  FROM q WINDOW o AS (PARTITION BY conv_id ORDER BY turn, ro, t)) WHERE o2 AND gap <= {chat.BUDGET / 4} AND NOT system"""
                            for j in range(1, chat.HISTORY + 1))
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS ro, coalesce(text, '') AS t FROM conversations
           UNION ALL SELECT -7, x, y, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(x, y)),
a AS (SELECT *, {tokens} AS k, CAST(length({role}) + length({esc.format('t')}) + 6 + {len(chat.END)} AS BIGINT) AS chars FROM c),
b AS (SELECT *, row_number() OVER o AS n, sum(k) OVER o AS e, first(ro) OVER o AS first_role, first(chars) OVER o AS first_chars
      FROM a WINDOW o AS (PARTITION BY conv_id ORDER BY turn, ro, t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT *, ceil(e / {chat.BUDGET / 2}) AS span FROM b),
q AS (SELECT *, coalesce(lag(span) OVER (PARTITION BY conv_id ORDER BY turn, ro, t) <> span, true) AS opens,
             n = 1 AND first_role = 'system' AS system FROM s),
x AS (SELECT conv_id, sum(chars) AS chars FROM ({near}) GROUP BY conv_id),
y AS (SELECT conv_id, count(*) AS n_turns, string_agg(ro || chr(10) || t || chr(10), '' ORDER BY turn, ro, t) AS told,
             coalesce(string_agg(t, '' ORDER BY turn, ro, t) FILTER (ro = 'assistant'), '') AS loss, sum(chars) AS chars,
             any_value(CASE WHEN first_role = 'system' THEN first_chars ELSE 0 END) * (count(DISTINCT span) - 1) AS opening
      FROM q GROUP BY conv_id)
SELECT y.conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(y.chars + opening + coalesce(x.chars, 0) AS BIGINT) AS formatted_chars
FROM y LEFT JOIN x ON x.conv_id = y.conv_id"""


def suffix_sql() -> str:
    n = suffix.WINDOW
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
l AS (SELECT *, CAST(octet_length(b) AS BIGINT) AS n FROM d),
g AS (SELECT r, i, array_slice(b, i, i + {n - 1}) AS k FROM (SELECT r, b, unnest(range(1, n - {n - 2})) AS i FROM l WHERE n >= {n})),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY k) > 1),
cut AS (SELECT r, i, CASE WHEN i > lag(i + {n}) OVER (PARTITION BY r ORDER BY i) OR lag(i) OVER (PARTITION BY r ORDER BY i) IS NULL
          THEN 1 ELSE 0 END AS new FROM twice),
num AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS s FROM cut),
span AS (SELECT r, s, min(i) AS a, max(i) + {n} AS z FROM num GROUP BY r, s),
edge AS (SELECT r, a, z, lead(a) OVER (PARTITION BY r ORDER BY a) AS nx, row_number() OVER (PARTITION BY r ORDER BY a) AS o FROM span),
part AS (SELECT l.r, 0 AS o, CASE WHEN e.a IS NULL THEN b WHEN e.a = 1 THEN ''::BLOB ELSE array_slice(b, 1, e.a - 1) END AS x
         FROM l LEFT JOIN edge e ON e.r = l.r AND e.o = 1
         UNION ALL
         SELECT e.r, e.o, CASE WHEN z > coalesce(nx - 1, n) THEN ''::BLOB ELSE array_slice(b, z, coalesce(nx - 1, n)) END
         FROM edge e JOIN l ON l.r = e.r),
kept AS (SELECT r, string_agg(hex(x), '' ORDER BY o) AS h FROM part GROUP BY r),
gone AS (SELECT r, sum(z - a) AS n, count(*) AS s FROM span GROUP BY r)
SELECT doc_id, l.n AS n_bytes, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(gone.s, 0) AS BIGINT) AS n_spans,
       sha256(unhex(h)) AS kept_sha256
FROM l JOIN kept ON kept.r = l.r LEFT JOIN gone ON gone.r = l.r"""


ORACLE_SQL = {
    "op2_minhash": minhash_sql(),
    "op3_mixing": mixing_sql(),
    "op4_rules": rules_sql(),
    "op5_warc": warc_sql(),
    "op6_substring": substring_sql(),
    "op7_chat": chat_sql(),
    "op9_suffix": suffix_sql(),
    "op12_linededup": linededup_sql(),
}
