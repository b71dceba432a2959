"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from pagemill.llm.license_scan import BASE, K, NEIGHBOURS, NOTICES, SHARE, STRETCH

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = f"""
WITH dw AS (SELECT doc_id, {_words('text', _ALNUM)} AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', _ALNUM)} AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(0, greatest(len(w) - 9, least(len(w), 1)))) AS i FROM bw),
win AS (SELECT DISTINCT item, w[i + 1 : i + 10] AS g FROM starts),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
places AS (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM dw, sizes),
grams AS (SELECT doc_id, n, i, w[i + 1 : i + n] AS g FROM places),
hits AS (SELECT doc_id, n, i, item FROM grams JOIN win USING (g)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

QUOTE_LINKS = r"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, unnest(str_split(text, chr(10))) AS line, generate_subscripts(str_split(text, chr(10)), 1) AS pos FROM conversations),
lines AS (SELECT conv_id, turn, pos, line, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level,
  lower(trim(regexp_replace(regexp_replace(line, '^(?:[ \t]*>)+', ''), '\s+', ' ', 'g'))) AS said FROM raw),
own AS (SELECT * FROM lines WHERE level = 0 AND said <> ''),
quoted AS (SELECT * FROM lines WHERE level > 0 AND said <> ''),
near AS (SELECT conv_id, said, min(turn) AS near FROM own GROUP BY 1, 2),
far AS (SELECT said, min({'c': conv_id, 't': turn}) AS far FROM own GROUP BY 1),
linked AS (SELECT q.conv_id, q.turn, q.level, length(q.said) AS chars,
  CASE WHEN near < q.turn THEN {'c': q.conv_id, 't': near} WHEN far < {'c': q.conv_id, 't': q.turn} THEN far END AS source
  FROM quoted q LEFT JOIN near n ON q.conv_id = n.conv_id AND q.said = n.said LEFT JOIN far f ON q.said = f.said),
votes AS (SELECT conv_id, turn, level, source, sum(chars) AS chars FROM linked WHERE source IS NOT NULL GROUP BY ALL),
best AS (SELECT conv_id, turn, source AS parent FROM votes QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, chars DESC, source DESC) = 1),
counted AS (SELECT conv_id, turn, count(*) AS n_quoted, count(source) AS n_linked, max(level) AS levels FROM linked GROUP BY 1, 2),
up AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM best
  UNION ALL SELECT up.conv_id, up.turn, best.parent, depth + 1 FROM up JOIN best ON up.root.c = best.conv_id AND up.root.t = best.turn),
top AS (SELECT conv_id, turn, root, depth FROM up QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth DESC) = 1),
body AS (SELECT conv_id, turn, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines WHERE level = 0 GROUP BY 1, 2)
SELECT m.conv_id, m.turn, m.role, coalesce(root.c, m.conv_id) AS thread_conv, coalesce(root.t, m.turn) AS thread_turn,
  CAST(coalesce(depth, 0) AS BIGINT) AS depth, parent.c AS parent_conv, parent.t AS parent_turn, CAST(coalesce(levels, 0) AS INT) AS levels,
  coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked, CASE WHEN text IS NOT NULL THEN coalesce(body, '') END AS body
FROM conversations m LEFT JOIN counted c ON m.conv_id = c.conv_id AND m.turn = c.turn LEFT JOIN best b ON m.conv_id = b.conv_id AND m.turn = b.turn
LEFT JOIN top t ON m.conv_id = t.conv_id AND m.turn = t.turn LEFT JOIN body o ON m.conv_id = o.conv_id AND m.turn = o.turn
"""


def license_scan() -> str:
    """The scan with its templates as a constant table."""
    rows = ", ".join(
        f"('{p}', '{label}', {base})" for phrases, base in ((BASE, "TRUE"), (NOTICES, "FALSE")) for p, label in phrases.items()
    )
    grams = lambda w: f"{w}[i + 1 : i + {K}]"
    return f"""
WITH t AS (SELECT template, label, is_base, str_split(template, ' ') AS w FROM (VALUES {rows}) v(template, label, is_base)),
tg AS (SELECT template, label, is_base, len(w) - {K - 1} AS n_grams, i, {grams('w')} AS g FROM (SELECT *, unnest(range(0, len(w) - {K - 1})) AS i FROM t)),
d AS (SELECT doc_id, {_words('text', _ALNUM)} AS w FROM documents),
dg AS (SELECT doc_id, i, {grams('w')} AS g FROM (SELECT *, unnest(range(0, len(w) - {K - 1})) AS i FROM d)),
hits AS (SELECT doc_id, template, label, is_base, n_grams, dg.i - tg.i AS diagonal, tg.i AS at_word FROM dg JOIN tg USING (g)),
by_diagonal AS (SELECT doc_id, template, label, is_base, n_grams, diagonal, list(at_word) AS at_words FROM hits GROUP BY ALL),
base AS (SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, list(DISTINCT label) AS base_labels
  FROM by_diagonal WHERE is_base AND len(at_words) = n_grams GROUP BY 1),
far AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {NEIGHBOURS}, TRUE) AS new FROM by_diagonal),
numbered AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM far),
merged AS (SELECT doc_id, template, label, n_grams, span, len(list_distinct(flatten(list(at_words)))) / any_value(n_grams) AS share,
  min(diagonal + list_min(at_words)) AS first, max(diagonal + list_max(at_words)) + {K} AS stop FROM numbered GROUP BY doc_id, template, label, n_grams, span),
spans AS (SELECT doc_id, list(DISTINCT label) AS span_labels, max(share) AS score FROM merged
  WHERE share >= {SHARE} AND stop - first <= {STRETCH} * (n_grams + {K - 1}) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(list_sort(base_labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_labels, []), coalesce(span_labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN spans USING (doc_id)
"""


SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (SELECT doc_id, k, substr(h, 1000 * k + 1, 1798) AS b FROM (SELECT doc_id, h, unnest(range(0, (length(h) // 2 - 399 + 499) // 500)) AS k FROM d)),
p AS (SELECT doc_id, k, b, unnest(range(0, least(500, length(b) // 2 - 399))) AS j FROM blocks),
s AS (SELECT doc_id, 500 * k + j AS i, md5(substr(b, 2 * j + 1, 800)) AS m FROM p),
hit AS (SELECT doc_id, i FROM s SEMI JOIN (SELECT m FROM s GROUP BY m HAVING count(*) > 1) r USING (m)),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER o + 400, TRUE) AS new FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, min(i) AS first, max(i) + 400 AS stop FROM numbered GROUP BY doc_id, span),
edges AS (SELECT doc_id, first, stop, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY first), 0) AS before FROM spans),
cut AS (SELECT doc_id, sum(stop - first) AS n_removed, count(*) AS n_spans, max(stop) AS last,
  string_agg(substr(h, 2 * before + 1, 2 * (first - before)), '' ORDER BY first) AS head FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

NGRAM_JACCARD = f"""
WITH RECURSIVE dw AS (SELECT doc_id, {_words('text', _NOT_SPACE)} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, least(len(w), 1)))) AS i FROM dw),
sh AS (SELECT DISTINCT doc_id, w[i + 1 : i + 3] AS g FROM places),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, b AS other FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
FROM dw d LEFT JOIN n USING (doc_id) LEFT JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id, n
"""

#: Leaves in order, the nodes of every level, the way up from each leaf (its runs and slots), and the fold along it.
MERKLE_MANIFEST = """
WITH RECURSIVE shown AS (
  SELECT doc_id, lang, source, n_chars, text, doc_id::VARCHAR AS d,
    list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text)::VARCHAR || ':' || CASE WHEN xor(crc, 4294967295) % 3 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS changed
  FROM (SELECT *, coalesce(strlen(d)::VARCHAR || ':' || d, '-') || coalesce(strlen(source)::VARCHAR || ':' || source, '-')
      || coalesce(strlen(lang)::VARCHAR || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR)::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head FROM shown)),
docs AS (
  SELECT *, coalesce('=' || lang, '') AS key, row_number() OVER () AS id,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
nodes(key, level, pos, n, digest) AS (
  SELECT key, 0::BIGINT, pos, n, leaf FROM docs
  UNION ALL
  SELECT key, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY key, level, pos // 8, n),
subroots AS (
  SELECT key, digest AS subroot, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(level, pos, n, digest) AS (
  SELECT 0::BIGINT, pos, n, subroot FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 8, n),
runs AS (SELECT key, level, pos // 8 AS run, list(digest ORDER BY pos) AS ds FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, pos // 8 AS run, list(digest ORDER BY pos) AS ds FROM tops WHERE n > 1 GROUP BY ALL),
ways AS (
  SELECT id, r.level, ds, ((d.pos // (8 ** r.level)::BIGINT) % 8)::BIGINT AS slot
  FROM docs d JOIN runs r ON r.key = d.key AND r.run = d.pos // (8 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT id, 1000 + r.level, ds, ((s.pos // (8 ** r.level)::BIGINT) % 8)::BIGINT
  FROM docs d JOIN subroots s ON s.key = d.key JOIN top_runs r ON r.run = s.pos // (8 ** (r.level + 1))::BIGINT),
steps AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level) AS step,
    array_to_string(ds[1:slot], '') AS before, array_to_string(ds[slot + 2:], '') AS after FROM ways),
proofs AS (SELECT id, string_agg(before || after, '' ORDER BY step) AS siblings, max(step) AS steps FROM steps GROUP BY id),
folds(id, step, digest) AS (
  SELECT id, 0::BIGINT, changed FROM docs
  UNION ALL
  SELECT f.id, s.step, sha256(s.before || f.digest || s.after) FROM folds f JOIN steps s ON s.id = f.id AND s.step = f.step + 1)
SELECT d.doc_id, d.leaf, r.subroot, t.digest AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256, f.digest AS folded_root,
  f.digest = t.digest AS verified
FROM docs d JOIN subroots r USING (key) JOIN tops t ON t.n = 1 LEFT JOIN proofs p ON p.id = d.id
JOIN folds f ON f.id = d.id AND f.step = coalesce(p.steps, 0)
"""
