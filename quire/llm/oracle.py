"""SQL restatements (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


#: Words as arrays, with their text's id.
_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP7 = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS run
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
), d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM windows))
), hits AS (SELECT DISTINCT doc_id, item_id, s, n FROM places JOIN windows USING (n, run)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY ALL),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


#: All pairs that share a shingle are counted in full; components grow until no link leaves them.
OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, list_slice(w, s, s + 4) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM sets a JOIN sets b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), half AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
), edges AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT doc_id AS id, doc_id AS other FROM d UNION SELECT id, b FROM reach JOIN edges ON a = other),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN least ON id = doc_id
"""


#: CRC-32: the table by its polynomial, and the checksum of a list of bytes.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(range(8), lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"""


def _crc32(bytes_: str) -> str:
    """Over a list of whole numbers; the one row of ``crc`` is in scope."""
    step = "lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({bytes_}, {step}, 4294967295::BIGINT), 4294967295)"


#: Large records one by one to the emptiest shard, then the order of digest and id cut at the level of the shards.
OP11 = rf"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t), docs AS (
  SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS h,
    {_crc32("list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)")} AS text_crc32
  FROM documents, crc
), total AS (SELECT sum(size)::BIGINT AS total FROM docs),
kinds AS (SELECT *, size * 24 * 256 > total AS is_large FROM docs, total),
large AS (SELECT *, row_number() OVER (ORDER BY size DESC, h, doc_id) AS g FROM kinds WHERE is_large),
dealt AS (
  SELECT 0::BIGINT AS g, list_transform(range(24), lambda i: 0::BIGINT) AS loads, -1::BIGINT AS shard
  UNION ALL
  SELECT g, list_transform(loads, lambda x, i: CASE WHEN i = p THEN x + size ELSE x END), p - 1
  FROM (SELECT l.g, l.size, d.loads, list_position(d.loads, list_min(d.loads))::BIGINT AS p FROM dealt d JOIN large l ON l.g = d.g + 1)
), loads AS (
  SELECT unnest(range(24)) AS shard, unnest(loads) AS load FROM (SELECT loads FROM dealt ORDER BY g DESC LIMIT 1)
), small AS (SELECT coalesce(sum(size), 0)::BIGINT AS small FROM kinds WHERE NOT is_large),
level AS (
  SELECT min((small + below + k - 1) // k) AS level
  FROM (SELECT sum(load) OVER (ORDER BY load, shard)::BIGINT AS below, row_number() OVER (ORDER BY load, shard) AS k FROM loads), small
), cuts AS (
  SELECT list(cut ORDER BY shard) AS cuts FROM (
    SELECT shard, least(small, sum(greatest(0, level - load)) OVER (ORDER BY shard))::BIGINT AS cut FROM loads, level, small
  ) WHERE shard < 23
), ranged AS (
  SELECT k.*, len(list_filter(cuts, lambda c: 2 * c <= middle)) AS shard
  FROM (SELECT *, 2 * sum(size) OVER (ORDER BY h, doc_id) - size AS middle FROM kinds WHERE NOT is_large) k, cuts
), ends AS (SELECT shard, count(*) AS n FROM dealt WHERE g > 0 GROUP BY shard),
places AS (
  SELECT doc_id, size, text_crc32, d.shard, row_number() OVER (PARTITION BY d.shard ORDER BY l.g) - 1 AS slot FROM large l JOIN dealt d USING (g)
  UNION ALL
  SELECT doc_id, size, text_crc32, r.shard, coalesce(n, 0) + row_number() OVER (PARTITION BY r.shard ORDER BY h, doc_id) - 1 FROM ranged r LEFT JOIN ends e ON e.shard = r.shard
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard, slot::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM places
"""


def _plus(cost: str, letter: str, state: str) -> str:
    return f"{{'c': ({state}).c + {cost}, 'a': {letter} || ({state}).a}}"


_FAR = "{'c': 1000000000::BIGINT, 'a': ''}"

#: Turns from the last to the first; z, o, e, s: nothing, an odd rest, an even rest, s and a rest are still to come.
_TURN_MATCH = "(CASE WHEN t.initial = '{0}' THEN 0 ELSE 2 END + t.cut)", "CASE WHEN t.initial = '{0}' THEN 'K' ELSE 'R' END"


def _matched(letter: str, state: str) -> str:
    cost, edit = (part.format(letter) for part in _TURN_MATCH)
    return f"CASE WHEN t.gone THEN {_FAR} ELSE {_plus(cost, edit, state)} END"


_Z = _plus("3", "'D'", "s.z")
_O = f"least({_plus('3', chr(39) + 'D' + chr(39), 's.o')}, {_matched('a', 'least(s.z, s.e)')})"
_E = f"least({_plus('3', chr(39) + 'D' + chr(39), 's.e')}, {_matched('u', 's.o')})"
_S = f"least({_plus('3', chr(39) + 'D' + chr(39), 's.s')}, CASE WHEN t.initial = 's' AND NOT t.gone THEN {_plus('t.cut', chr(39) + 'K' + chr(39), 's.e')} ELSE {_FAR} END)"

OP12 = rf"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS t), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)")} % 20 AS fault
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM given WHERE fault <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), faults AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]')[-1] AS final,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed
), turns AS (
  SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, final IS NULL AS blank, final IS NOT NULL AND seen AS duplicate,
    final IS NOT NULL AND NOT seen AND final NOT IN ('.', '!', '?') AS truncated, final IS NULL OR seen AS gone, truncated::BIGINT AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM faults
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM turns GROUP BY conv_id
), states AS (
  SELECT conv_id, n AS i, {{'c': 0::BIGINT, 'a': ''}} AS z, {{'c': 2::BIGINT, 'a': 'I'}} AS o, {{'c': 4::BIGINT, 'a': 'II'}} AS e, {_FAR} AS s FROM facts
  UNION ALL
  SELECT conv_id, i - 1, z, least(o, {_plus("2", "'I'", "z")}, {_plus("2", "'I'", "e")}), least(e, {_plus("2", "'I'", "o")}, {_plus("4", "'II'", "z")}), s FROM (
    SELECT s.conv_id, s.i, {_Z} AS z, {_O} AS o, {_E} AS e, {_S} AS s FROM states s JOIN turns t ON t.conv_id = s.conv_id AND t.i = s.i
  )
), audits AS (SELECT conv_id, least(z, e, s).c AS cost, least(z, e, s).a AS audit FROM states WHERE i = 0),
letters AS (SELECT conv_id, p, substr(audit, p, 1) AS letter, length(replace(audit, 'D', '')) AS m FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM audits)),
edits AS (
  SELECT *, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w - 1 - m % 2 AS place FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), repaired AS (
  SELECT e.conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS body
  FROM edits e LEFT JOIN turns t ON t.conv_id = e.conv_id AND t.i = e.i WHERE letter <> 'D' GROUP BY e.conv_id
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN facts USING (conv_id) LEFT JOIN audits USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""


def statements() -> dict[str, str]:
    return {"op3_topk_search": OP3, "op5_near_duplicates": OP5, "op7_decontaminate": OP7, "op11_sampled_sharding": OP11, "op12_conversation_repair": OP12}
