"""The same questions in DuckDB SQL, where SQL can express them over whole tables."""

from __future__ import annotations

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"



def _escaped(text: str, role: bool = False) -> str:
    """Length of a text once control characters are written as two characters."""
    out = f"replace(replace(replace({text}, '\\', '\\b'), '<', '\\l'), '#', '\\h')"
    return f"replace({out}, ':', '\\c')" if role else out


def _field(value: str) -> str:
    """A value as it enters a leaf of the Merkle manifest."""
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE CAST(strlen({text}) AS VARCHAR) || ':' || {text} END"


ORACLES = {
    "op3_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '### Assistant: </turn> ok'),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(4 + length({_escaped("role", True)}) + 2 + length({_escaped("text")}) + 8) AS chars
  FROM t GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(chars AS BIGINT) AS formatted_chars
FROM g
""",
    "op2_decontamination": rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(words)) AS n,
         array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(2, len(words) - 8))) AS r(i)
  WHERE len(words) > 0),
lengths AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, lengths WHERE len(words) >= n)),
hits AS (SELECT doc_id, item, dw.n, i FROM dw JOIN bw USING (win) WHERE dw.n = bw.n),
spots AS (SELECT doc_id, count(DISTINCT s) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS s FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op8_warc_zip": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS page FROM p WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page IS NOT NULL AND page IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page IS DISTINCT FROM page_id THEN page END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
  FROM range(256) AS r(i)),
rows AS (
  SELECT doc_id, lang, {_field("doc_id")} || {_field("source")} || {_field("lang")} || {_field("n_chars")} AS head, text,
         doc_id IS NOT NULL AND xor(list_reduce(
             list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, entry[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 3 = 0 AS bad
  FROM documents, crc_table),
hashed AS (
  SELECT doc_id, lang, sha256(head || {_field("text")}) AS leaf,
         CASE WHEN bad THEN sha256(head || {_field(f"translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')")}) END AS changed
  FROM rows),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
up(level, lang, pos, digest, n) AS (
  SELECT 0, lang, pos, leaf, n FROM leaves
  UNION ALL
  SELECT level + 1, lang, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM up WHERE n > 1 GROUP BY level, lang, pos // 8),
langs AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM up WHERE n = 1),
over_langs(level, pos, digest, n) AS (
  SELECT 0, pos, subroot, n FROM langs
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(n) + 7) // 8
  FROM over_langs WHERE n > 1 GROUP BY level, pos // 8),
root AS (SELECT digest AS root FROM over_langs WHERE n = 1),
steps AS (
  SELECT level, lang, pos, coalesce(string_agg(digest, '') OVER lower_slots, '') AS l,
         coalesce(string_agg(digest, '') OVER higher_slots, '') AS r
  FROM up WHERE n > 1
  WINDOW lower_slots AS (PARTITION BY level, lang, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    higher_slots AS (PARTITION BY level, lang, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
lang_steps AS (
  SELECT level, pos, coalesce(string_agg(digest, '') OVER lower_slots, '') AS l,
         coalesce(string_agg(digest, '') OVER higher_slots, '') AS r
  FROM over_langs WHERE n > 1
  WINDOW lower_slots AS (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    higher_slots AS (PARTITION BY level, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
climb(lang, leaf_pos, level, pos, so_far, proof) AS (
  SELECT lang, pos, 0, pos, coalesce(changed, leaf), '' FROM leaves
  UNION ALL
  SELECT c.lang, leaf_pos, c.level + 1, c.pos // 8, sha256(l || so_far || r), proof || l || r
  FROM climb c JOIN steps s ON s.level = c.level AND s.lang IS NOT DISTINCT FROM c.lang AND s.pos = c.pos),
in_lang AS (
  SELECT lang, leaf_pos, max_by(so_far, level) AS so_far, max_by(proof, level) AS proof FROM climb GROUP BY lang, leaf_pos),
lang_climb(lang, leaf_pos, level, pos, so_far, proof) AS (
  SELECT i.lang, leaf_pos, 0, g.pos, so_far, proof FROM in_lang i JOIN langs g ON g.lang IS NOT DISTINCT FROM i.lang
  UNION ALL
  SELECT c.lang, leaf_pos, c.level + 1, c.pos // 8, sha256(l || so_far || r), proof || l || r
  FROM lang_climb c JOIN lang_steps s ON s.level = c.level AND s.pos = c.pos),
ended AS (
  SELECT lang, leaf_pos, max_by(so_far, level) AS folded_root, sha256(max_by(proof, level)) AS proof_sha256
  FROM lang_climb GROUP BY lang, leaf_pos)
SELECT v.doc_id, v.leaf, g.subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves v JOIN ended e ON e.lang IS NOT DISTINCT FROM v.lang AND e.leaf_pos = v.pos
JOIN langs g ON g.lang IS NOT DISTINCT FROM v.lang, root
""",
}
