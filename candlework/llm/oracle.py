"""DuckDB SQL for the registered queries that SQL can express over whole tables."""

from __future__ import annotations

OP1 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS host, text, coalesce(text, '') AS plain FROM documents
), words AS (
  SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM (SELECT row, regexp_extract_all(plain, '[^\x20\x09-\x0D]+') AS words FROM docs)
), windows AS (
  SELECT row, place, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c FROM words
  WINDOW w AS (PARTITION BY row ORDER BY place)
), repeated AS (
  SELECT row, count(DISTINCT place + k) AS n_repeat_words
  FROM (SELECT row, place FROM windows WHERE c IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY row, a, b, c) > 1), range(3) s(k)
  GROUP BY row
), lines AS (
  SELECT row, host, text, line, lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')) AS key,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT row, host, text, unnest(string_split(plain, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), doubled AS (
  SELECT row, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY row
), hosts AS (
  SELECT host, count(DISTINCT text) AS total FROM docs WHERE text IS NOT NULL GROUP BY host
), common AS (
  SELECT host, key FROM lines JOIN hosts USING (host) GROUP BY host, key, total
  HAVING count(DISTINCT text) >= 10 AND count(DISTINCT text) >= CAST(0.1 AS DOUBLE) * total
), lost AS (
  SELECT row, CAST(sum(n) AS BIGINT) AS n_common_words FROM lines JOIN common USING (host, key) GROUP BY row
), measured AS (
  SELECT doc_id, len(regexp_extract_all(plain, '[^\x20\x09-\x0D]+')) AS n_words,
         length(regexp_replace(plain, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(plain) - length(regexp_replace(plain, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_common_words, 0) AS n_common_words
  FROM docs LEFT JOIN doubled USING (row) LEFT JOIN repeated USING (row) LEFT JOIN lost USING (row)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_common_words <= n_words AS kept,
       n_common_words
FROM measured
"""

OP2 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[p : p + n - 1], ' ') AS said
  FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p
        FROM items WHERE len(words) > 0)
), places AS (
  SELECT row, p, n, array_to_string(words[p : p + n - 1], ' ') AS said
  FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS p
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(words) >= n)
), found AS (
  SELECT row, p, n, item_id FROM places JOIN windows USING (n, said)
), hit AS (
  SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS place FROM found) GROUP BY row
), listed AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN listed USING (row)
"""



def _remainder(byte: int) -> int:
    """Of the checksum's division, for one byte."""
    for _ in range(8):
        byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
    return byte


#: The remainder of a byte is that of its bits, added without carry.
_STEP = "crc >> 8"
for _bit in range(8):
    _STEP = f"xor({_STEP}, (xor(crc, byte) >> {_bit} & 1) * {_remainder(1 << _bit)})"

OP3 = f"""
WITH sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
         xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                        lambda x: CAST('0x' || x AS BIGINT)),
                         lambda crc, byte: {_STEP}), 4294967295) AS text_crc32
  FROM documents
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id) AS until, sum(size) OVER () AS total FROM sized
), sharded AS (
  SELECT *, CAST((2 * until - size) * 24 // (2 * total) AS INTEGER) AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""

OP6 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p : p + least(len(words), 5) - 1], ' ') AS said
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - least(len(words), 5) + 2)) AS p FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
        FROM shingles x JOIN shingles y ON x.said = y.said AND x.doc_id <> y.doc_id GROUP BY ALL) s
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
), reached AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP7 = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), plain AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         length(replace(replace(replace(coalesce(role, ''), '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS role_size,
         length(replace(replace(coalesce(text, ''), '\', '\\'), '<|', '<\|')) AS text_size
  FROM rows
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(12 + role_size + 1 + text_size + 11) AS BIGINT) AS formatted_chars
  FROM plain GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""

OP11 = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), sizes AS (
  SELECT doc_id, len(words) AS n FROM doc_words WHERE len(words) > 0
), whole AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes
), measured AS (
  SELECT doc_id, 100 - 75 + ((75 * n * docs) // length) AS m FROM sizes, whole
), tfs AS (
  SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS word FROM doc_words) GROUP BY ALL
), weights AS (
  SELECT word, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, whole GROUP BY word
), wanted AS (
  SELECT item_id, word, count(*) AS times FROM (SELECT item_id, unnest(words) AS word FROM item_words) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (word) JOIN tfs USING (word) JOIN measured USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

OP12 = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, doc_id, source, text, CASE WHEN doc_id IS NULL THEN 1 ELSE
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte)] || range(8),
        lambda rest, bit: CASE WHEN rest & 1 = 1 THEN xor(rest >> 1, 3988292384) ELSE rest >> 1 END)), 4294967295) % 5
    END = 0 AS tampered,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS fields
  FROM documents
), leaves AS (
  SELECT row, doc_id, source, sha256(fields || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         CASE WHEN tampered THEN sha256(fields || coalesce(octet_length(encode(text)) || ':'
           || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed
  FROM rows
), sources AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves GROUP BY source
), placed AS (
  SELECT l.*, s.tree, s.n, row_number() OVER (PARTITION BY s.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM leaves l JOIN sources s ON l.source IS NOT DISTINCT FROM s.source
), nodes AS (
  SELECT tree, n, 0 AS level, place, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, (n + 15) // 16, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY tree, n, level, place // 16
), subroots AS (
  SELECT tree, digest, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT n, 0 AS level, tree AS place, digest FROM subroots
  UNION ALL
  SELECT (n + 15) // 16, level + 1, place // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY n, level, place // 16
), siblings AS (
  SELECT tree, level, place, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY tree, level, place // 16 ORDER BY place)
  UNION ALL
  SELECT NULL, 100 + level, place, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
  FROM tops WHERE n > 1 WINDOW run AS (PARTITION BY level, place // 16 ORDER BY place)
), steps AS (
  SELECT p.row, s.before, s.after, row_number() OVER (PARTITION BY p.row ORDER BY s.level) AS step
  FROM placed p JOIN siblings s
    ON (s.tree = p.tree AND s.place = p.place >> (4 * s.level)) OR (s.tree IS NULL AND s.place = p.tree >> (4 * (s.level - 100)))
), folded AS (
  SELECT row, 0 AS step, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT s.row, s.step, sha256(s.before || f.digest || s.after) FROM folded f JOIN steps s ON s.row = f.row AND s.step = f.step + 1
), results AS (
  SELECT row, arg_max(digest, step) AS folded_root FROM folded GROUP BY row
), proofs AS (
  SELECT row, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY row
)
SELECT p.doc_id, p.leaf, u.digest AS subroot, r.digest AS root, sha256(coalesce(f.proof, '')) AS proof_sha256,
       e.folded_root, e.folded_root = r.digest AS verified
FROM placed p JOIN subroots u USING (tree) JOIN (SELECT digest FROM tops WHERE n = 1) r ON true
JOIN results e USING (row) LEFT JOIN proofs f USING (row)
"""

OP13 = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS text
  FROM documents
), grouped AS (
  SELECT doc_id, text, count(*) OVER (PARTITION BY text) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text ORDER BY points DESC, doc_id) AS keep_id
  FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM grouped
"""

ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op2_decontamination": OP2,
    "op3_sharding": OP3,
    "op6_ngram_jaccard_join": OP6,
    "op7_chat_formatting": OP7,
    "op11_lexical_search": OP11,
    "op12_merkle_manifest": OP12,
    "op13_exact_dedup": OP13,
}
