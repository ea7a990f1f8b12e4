"""DuckDB statements for the corpus queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP3_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
out AS (
  SELECT *, length(replace(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), '<|', '\p'), ':', '\c'))
    + length(replace(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e'), '<|', '\p'))
    + length('### ' || ': ' || '</turn>' || chr(10)) AS n
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(n) AS BIGINT) AS formatted_chars
FROM out GROUP BY conv_id
"""

OP8_DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS l, array_to_string(list_slice(w, s, s + 12), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
dw AS (
  SELECT doc_id, l, s, array_to_string(list_slice(w, s, s + l - 1), ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s
        FROM doc CROSS JOIN (SELECT DISTINCT l FROM bw))),
hit AS (SELECT doc_id, s, dw.l, item_id FROM dw JOIN bw ON dw.l = bw.l AND dw.win = bw.win),
places AS (SELECT doc_id, count(DISTINCT p) AS n
           FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT cast(item_id AS VARCHAR))) AS i FROM hit GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n, 0) AS BIGINT) AS n_hit,
       cast(coalesce(len(i), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(i, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
