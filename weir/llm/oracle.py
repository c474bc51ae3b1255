"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHAT = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, '<s>[INST] ' || regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') || ' [/INST]'
         || regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') || '</s>' AS rendered FROM src)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, rendered)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, rendered) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(rendered))::BIGINT AS formatted_chars, true AS identical
FROM r GROUP BY conv_id
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, 'null') || '/' || coalesce(text, '')) AS h FROM documents),
e AS (
  SELECT *, length(size::VARCHAR) * 100 + substr(size::VARCHAR || '0', 1, 2)::INT AS class, substr(h, 1, 2) AS slice FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM e GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size::DOUBLE * 3 AS cap FROM s),
f AS (
  SELECT *, row_number() OVER o AS k,
         (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS share
  FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
t AS (
  SELECT source, source_size,
         CASE WHEN cap >= share * w THEN (SELECT arg_min(share, k) FROM f WHERE cap >= share * w) * w ELSE cap END AS target FROM f),
r AS (
  SELECT e.doc_id, e.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY e.source ORDER BY e.class, e.slice, e.size, substr(e.h, 3)) AS rank,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
         ('0x' || substr(sha256('mix-1' || CASE WHEN e.source IS NULL THEN '/null' ELSE '/s:' || e.source END), 1, 5))::INT::DOUBLE / 1048576 AS u
  FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(each * rank + u) - floor(each * (rank - 1) + u)) * size)::BIGINT AS taken FROM r
"""


LINES = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM d WHERE x IS NOT NULL),
b AS (
  SELECT doc_id, i, line, lead(line, 1) OVER o AS l2, lead(line, 2) OVER o AS l3, lead(i, 2) OVER o AS j
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT doc_id, i, j, row_number() OVER (PARTITION BY line || chr(10) || l2 || chr(10) || l3 ORDER BY doc_id, i) AS k
  FROM b WHERE j IS NOT NULL),
c AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM r WHERE k > 1),
g AS (
  SELECT l.doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (c.i IS NULL) AS kept
  FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

SUBSTRING = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS word, generate_subscripts(x, 1) AS i FROM d),
b AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER f AS win, count(*) OVER f AS n FROM l
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM b WHERE n = 20),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r WHERE k > 1),
g AS (
  SELECT l.doc_id, count(*) AS n_words, count(c.i) AS n_removed,
         string_agg(l.word, ' ' ORDER BY l.i) FILTER (c.i IS NULL) AS kept
  FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

TRIE = r"""
WITH RECURSIVE t8 AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS tab
  FROM range(256) r(i)),
t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda x, b: xor(x >> 8, tab[(xor(x, b) & 255) + 1])), 4294967295::BIGINT) % 4 AS h FROM t, t8),
z AS (SELECT conv_id AS base, count(*) AS n FROM t GROUP BY conv_id),
u AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(z.n, 0)), t.role, t.text
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN z ON z.base = c.base),
k AS (
  SELECT conv_id, pos AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '/') OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM u
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
m AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM k GROUP BY key, depth),
e AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends
  FROM (SELECT * FROM k QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY key),
p AS (SELECT DISTINCT k.key, j.key AS parent FROM k JOIN k j ON j.conv_id = k.conv_id AND j.depth = k.depth - 1),
n AS (SELECT parent AS key, count(*) AS n_children FROM p GROUP BY parent),
s AS (
  SELECT a.key, count(*) FILTER (n.key IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.words)::BIGINT AS saved_tokens
  FROM (SELECT DISTINCT k.key, j.key AS below FROM k JOIN k j ON j.conv_id = k.conv_id AND j.depth >= k.depth) a
  JOIN m ON m.key = a.below LEFT JOIN n ON n.key = a.below GROUP BY a.key)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, coalesce(n.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM m JOIN s ON s.key = m.key LEFT JOIN n ON n.key = m.key LEFT JOIN e ON e.key = m.key
LEFT JOIN p ON p.key = m.key LEFT JOIN m q ON q.key = p.parent
"""

PHRASES = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[.,;:!?\x0A-\x0D]') AS x FROM documents),
p AS (SELECT doc, lang, unnest(x) AS piece, generate_subscripts(x, 1) AS p FROM d),
w AS (
  SELECT doc, lang, p, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w1,
         generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS i FROM p),
r AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM w WINDOW o AS (PARTITION BY doc, p ORDER BY i)),
g AS (
  SELECT lang, phrase, m, count(*) AS f FROM (
    SELECT lang, w1 AS phrase, 1 AS m FROM r
    UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM r WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM r WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM r WHERE w4 IS NOT NULL)
  GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS x FROM g WHERE m > 1),
k AS (
  SELECT c.lang, c.phrase, c.a, k, array_to_string(x[:k], ' ') AS lp, array_to_string(x[k + 1:], ' ') AS rp
  FROM c, (VALUES (1), (2), (3)) t(k) WHERE k < m),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * k.a) // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM k JOIN g l ON l.lang = k.lang AND l.phrase = k.lp JOIN g r ON r.lang = k.lang AND r.phrase = k.rp),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
u AS (
  SELECT lang, array_to_string(x[i:i + z - 1], ' ') AS phrase, max(a) AS around
  FROM c, (VALUES (2), (3)) t(z), (VALUES (1), (2), (3)) v(i) WHERE z < m AND i + z - 1 <= m GROUP BY ALL),
o AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score,
         row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM b LEFT JOIN u ON u.lang = b.lang AND u.phrase = b.phrase
  WHERE u.around IS NULL OR 100::HUGEINT * u.around < 80::HUGEINT * b.a)
SELECT o.lang, o.rank, o.phrase, o.a, o.l, o.r, n.n, o.score FROM o JOIN n ON n.lang = o.lang WHERE o.rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": CHAT, "op3_line_dedup": LINES, "op4_source_mixing": MIXING,
            "op6_substring_dedup": SUBSTRING, "op11_conversation_prefix_trie": TRIE,
            "op12_phrase_collocation_mining": PHRASES}
