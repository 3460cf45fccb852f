"""DuckDB SQL for those training-data queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_PLAIN = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _passages(documents: str = "documents", window: int = 50) -> str:
    """Common table expressions: d (doc_id, w: words) and gone (doc_id, p: removed word, from 1)."""
    return f"""
d AS (SELECT doc_id, coalesce({_SPACED.format('text')}, []) AS w FROM {documents}),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + {window - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window} + 2)) AS s FROM d)),
least AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {window})) AS p
  FROM windows JOIN least USING (h) WHERE doc_id > least)"""


def _linked(documents: str, gram: int, share: int) -> str:
    """Common table expressions: sets (doc_id, n), and reach (a, b) over all links."""
    return f"""
words AS (SELECT doc_id, coalesce({_SPACED.format(_LOWER.format('text'))}, []) AS w FROM {documents}),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + {gram - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {gram} + 2, 2))) AS s FROM words WHERE len(w) > 0)),
sets AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * i >= {share} * (p.n + q.n - i)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT a, b FROM both_ways
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)"""


OP4 = f"""
WITH RECURSIVE {_linked('documents', 4, 85)}
SELECT w.doc_id, coalesce(any_value(n), 0) AS n_shingles, least(w.doc_id, coalesce(min(b), w.doc_id)) AS component_id
FROM words w LEFT JOIN sets USING (doc_id) LEFT JOIN reach ON a = w.doc_id
GROUP BY w.doc_id"""

OP5 = f"""
WITH {_passages()},
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
  FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def _hits(documents: str = "documents", window: int = 13) -> str:
    """Common table expressions: d (doc_id, w), found (doc_id, s, n, item_id)."""
    return f"""
d AS (SELECT doc_id, coalesce({_PLAIN.format('text')}, []) AS w FROM {documents}),
items AS (SELECT item_id, {_PLAIN.format('text')} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), {window}) AS n, array_to_string(w[s:s + least(len(w), {window}) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {window} + 2, 2))) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes)),
found AS (SELECT doc_id, s, n, item_id FROM doc_windows JOIN item_windows USING (n, x))"""


OP6 = f"""
WITH {_hits()},
hit AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, i:
      CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT)"""

OP12 = f"""
WITH keyed AS (
  SELECT conv_id, turn, md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len({_SPACED.format("coalesce(text, '')")}) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS l, {_CRC32} % 4 AS h FROM keyed GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.l[1:c.h], []), c.l[c.h + 1:]) AS l
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
paths AS (SELECT conv_id, list_transform(l, lambda x: x.k) AS ks, list_transform(l, lambda x: x.w) AS ws FROM rebuilt),
steps AS (
  SELECT conv_id, d, array_to_string(ks[1:d], '') AS p, coalesce(ws[d], 0) AS w, len(ks) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM paths)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, max(w) * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY p, d),
children AS (SELECT p[1:32 * (d - 1)] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(c.n, 0) AS n_children FROM nodes LEFT JOIN children c USING (p)),
under AS (
  SELECT p[1:32 * a] AS p, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY 1)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n AS n_convs, x.n_children,
       under.n_leaves::BIGINT AS n_leaves, under.saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM counted x JOIN under USING (p) LEFT JOIN nodes u ON x.d > 0 AND u.p = x.p[1:32 * (x.d - 1)]"""

OP13 = f"""
WITH terms AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN.format('text')} AS w FROM documents),
docs AS (SELECT doc_id, r, w, len(w) AS n FROM terms WHERE len(w) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest({_PLAIN.format('text')}) AS t FROM benchmark),
cells AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM items) GROUP BY r, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS x
  FROM cells, corpus GROUP BY t, docs),
impacts AS (
  SELECT r, t, x * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS s
  FROM cells JOIN docs USING (r) JOIN weights USING (t), corpus),
scored AS (
  SELECT item_id, r, doc_id, sum(s)::BIGINT AS score
  FROM impacts JOIN items USING (t) JOIN docs USING (r) GROUP BY item_id, r, doc_id HAVING sum(s) > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored)
WHERE rank <= 10"""

ORACLE: dict[str, str] = {
    "op4_ngram_jaccard_join": OP4,
    "op5_substring_dedup": OP5,
    "op6_decontamination": OP6,
    "op12_conversation_trie": OP12,
    "op13_lexical_search": OP13,
}
