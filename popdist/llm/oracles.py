"""DuckDB SQL for the queries of this subpackage that SQL can express."""

EXACT_DEDUP = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM t
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = f"""
WITH items AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
size AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n, (count(*) OVER ())::BIGINT AS big_n, (sum(len(terms)) OVER ())::BIGINT AS big_l
  FROM docs WHERE len(terms) > 0),
tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
score AS (
  SELECT item, item_id, r, doc_id, sum(
    floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l))))::BIGINT AS score
  FROM items JOIN df USING (term) JOIN tf USING (term) JOIN size USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM score WHERE score > 0)
WHERE rank <= 50
"""

#: crc32 of a decimal number by its table of 256 entries, built from the polynomial
PREFIX_TRIE = r"""
WITH RECURSIVE tab AS (
  SELECT i, 0 AS k, i AS v FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM tab WHERE k < 8),
crc AS (
  SELECT DISTINCT conv_id, conv_id::VARCHAR AS s, 1 AS p, 4294967295::BIGINT AS c FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT conv_id, s, p + 1, xor(c >> 8, v) FROM crc JOIN (SELECT i, v FROM tab WHERE k = 8) t
    ON t.i = xor(c, ascii(s[p])::BIGINT) & 255 WHERE p <= length(s)),
heads AS (SELECT conv_id, xor(c, 4294967295) % 4 AS h FROM crc WHERE p = length(s) + 1),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations),
again AS (
  SELECT h.conv_id, 0 AS own, place, role, text FROM heads h JOIN turns t
    ON t.conv_id = h.conv_id - h.conv_id % 20 AND place <= h
  UNION ALL
  SELECT h.conv_id, 1, place, role, text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND place > h),
paths AS (
  SELECT conv_id, coalesce(list(sha256(length(role) || ':' || role || text) ORDER BY own, place) FILTER (WHERE place IS NOT NULL), []) AS path,
         coalesce(list(len(regexp_extract_all(text, '[^ 	-]+')) ORDER BY own, place) FILTER (WHERE place IS NOT NULL), []) AS words
  FROM heads LEFT JOIN again USING (conv_id) GROUP BY conv_id),
members AS (
  SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path, words FROM paths),
nodes AS (
  SELECT depth, array_to_string(path[:depth], '') AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth > 0 THEN any_value(words[depth]) ELSE 0 END AS last_words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '')) AS ends_sha256,
         any_value(path[:depth]) AS path
  FROM members GROUP BY depth, node),
kids AS (SELECT depth - 1 AS depth, array_to_string(path[:depth - 1], '') AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
told AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, node)),
below AS (SELECT unnest(range(depth + 1)) AS up, path, n_children, (n_convs - 1) * last_words AS saved FROM told),
sums AS (
  SELECT up AS depth, array_to_string(path[:up], '') AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM below GROUP BY ALL)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves,
       saved::BIGINT AS saved_tokens, t.ends_sha256
FROM told t JOIN sums USING (depth, node)
LEFT JOIN nodes p ON p.depth = t.depth - 1 AND p.node = array_to_string(t.path[:t.depth - 1], '')
"""

_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")


def _escaped_length(column: str) -> str:
    escaped = rf"replace({column}, '\', '\\')"
    for c in _CONTROLS:
        escaped = rf"replace({escaped}, '{c}', '{c[0]}\{c[1:]}')"
    return f"length({escaped})"


CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum({_escaped_length("text")} + CASE role WHEN 'assistant' THEN length('<s></s>') WHEN 'user' THEN length('<s>[INST]  [/INST]')
           WHEN 'system' THEN length('<s><<SYS>>  <</SYS>>') ELSE length('<s>[ROLE]  [/ROLE] ') + {_escaped_length("role")} END
       )::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_chat_format": CHAT_FORMAT,
}
