"""The registered queries restated in plain SQL over the given tables."""

from __future__ import annotations

from quire.functions.identity import DOCUMENT_ID_NAMESPACE
from quire.functions.pdf_dates import PDF_DATE_PATTERN
from quire.operators.chunks import TREE_FANOUT
from quire.operators.ranking import BM25_B, BM25_K
from quire.plans.queries import ALL_TERMS, CHUNK_BYTES, RANKED, STOP_WORDS, SUBSTRING, WILDCARD
from quire.sources.adapters import DATE_CASES, FIRST_MODIFIED, MIXED_ENDINGS, PAGE_CHARS

_NS = DOCUMENT_ID_NAMESPACE.replace("-", "")


def _uuid(digest: str) -> str:
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({digest}, 17, 1)) - 1) % 4 + 1, 1)"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"{variant} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


_FILES = f"""
files AS (
  SELECT doc_id AS ordinal, '/' || source || '/' || doc_id || '.txt' AS file_path,
         doc_id || '.txt' AS file_name, encode(text) AS content, text, lang,
         octet_length(encode(text)) AS file_size_bytes, sha256(encode(text)) AS sha256_hex
    FROM documents),
digested AS (SELECT *, sha1(from_hex('{_NS}') || encode(sha256_hex)) AS g FROM files),
named AS (SELECT * EXCLUDE (g), {_uuid('g')} AS document_id FROM digested)
"""
# One document per content: the first file of it.
_DOCS = f"""{_FILES},
docs AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY sha256_hex ORDER BY ordinal) = 1)
"""


def _cut(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (i), i + 1 AS page_number,
         substr(text, (i * {PAGE_CHARS} + 1)::BIGINT, {PAGE_CHARS}) AS page_text
    FROM (SELECT *, unnest(range(0, (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS})) AS i FROM {source}))
"""


_PAGES = f"{_DOCS}, {_cut('docs', 'doc_pages')}"
# Pages of every file; the id comes from the path.
_PATH_PAGES = f"""{_FILES},
by_path AS (
  SELECT * EXCLUDE (g), {_uuid('g')} AS document_id
    FROM (SELECT *, sha1(from_hex('{_NS}') || encode(sha256(file_path))) AS g FROM files)),
{_cut('by_path', 'path_pages')}
"""
_NONBLANK = r"regexp_matches(page_text, '[^\s\x0b\x1c-\x1f\x85\xa0]')"
_CHUNKS = f"""{_DOCS},
doc_chunks AS (
  SELECT document_id, file_name, i AS chunk_index, i * {CHUNK_BYTES} AS byte_offset,
         array_slice(content, i * {CHUNK_BYTES} + 1, (i + 1) * {CHUNK_BYTES}) AS piece
    FROM (SELECT *, unnest(range(0, (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES})) AS i FROM docs))
"""


def _table_counts(documents: str) -> str:
    return f"""WITH {_DOCS}, kept AS ({documents}), {_cut('kept', 'kept_pages')},
    p AS (SELECT document_id, count(*) AS live_pages, sum(length(page_text))::BIGINT AS live_chars
            FROM kept_pages GROUP BY 1)
    SELECT document_id, file_name, file_size_bytes, live_pages, live_chars,
           (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES} AS live_chunks, file_size_bytes AS live_bytes
      FROM kept LEFT JOIN p USING (document_id)"""


_ALL = "SELECT * FROM docs"
_NOT_FRENCH = "SELECT * FROM docs WHERE sha256_hex NOT IN (SELECT sha256_hex FROM named WHERE lang = 'fr')"

_SPLIT = "string_split_regex(lower(strip_accents({0})), '[^a-z]+')"


def _index(pages: str = "doc_pages", form: str = "term", left_out: str = "''") -> str:
    """Postings, document frequencies and totals over page rows."""
    return f"""
words AS (
  SELECT document_id, page_number, unnest({_SPLIT.format('page_text')}) AS term FROM {pages}),
postings AS (
  SELECT document_id, page_number, form AS term, count(*) AS tf
    FROM (SELECT document_id, page_number, {form} AS form FROM words WHERE term NOT IN ('', {left_out}))
   GROUP BY ALL),
lengths AS (SELECT document_id, page_number, sum(tf)::BIGINT AS page_len FROM postings GROUP BY ALL),
terms AS (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS total_tf, max(tf) AS max_tf, min(page_len) AS min_len
    FROM postings JOIN lengths USING (document_id, page_number) GROUP BY term),
totals AS (
  SELECT (SELECT count(*) FROM {pages}) AS n_pages,
         (SELECT sum(tf) FROM postings)::DOUBLE / (SELECT count(*) FROM {pages}) AS avg_len)
"""


_WEIGHT = f"""log10((n_pages - df + 0.5) / (df + 0.5) + 1)
  * (tf * ({BM25_K} + 1) / (tf + {BM25_K} * (1 - {BM25_B} + {BM25_B} * page_len / avg_len)))"""


def _ranked(
    query: str, top_k: int, all_terms: bool = False, decimals: int = 3, live: str | None = None, **index: str
) -> str:
    terms = sorted(set(query.split()))
    listed = ", ".join(f"'{t}'" for t in terms)
    having = f"HAVING count(*) = {len(terms)}" if all_terms else ""
    alive = f"WHERE document_id IN (SELECT document_id FROM ({live}))" if live else ""
    return f"""WITH {_PAGES}, {_index(**index)},
scored AS (
  SELECT document_id, page_number, sum({_WEIGHT}) AS score
    FROM postings JOIN terms USING (term) JOIN lengths USING (document_id, page_number), totals
   WHERE term IN ({listed}) GROUP BY ALL {having})
SELECT file_name, page_number, round(score, {decimals}) AS score, substr(page_text, 1, 300) AS snippet, document_id
  FROM scored JOIN doc_pages USING (document_id, page_number) {alive}
 ORDER BY round(score, 9) DESC, document_id, page_number LIMIT {top_k}"""


_BATCH = f"""WITH {_PAGES}, {_index()},
asked AS (
  SELECT item_id AS query_id, text AS query FROM benchmark),
asked_terms AS (
  SELECT DISTINCT query_id, term
    FROM (SELECT query_id, unnest({_SPLIT.format('query')}) AS term FROM asked) WHERE term <> ''),
scored AS (
  SELECT query_id, document_id, page_number, sum({_WEIGHT}) AS score
    FROM asked_terms JOIN postings USING (term) JOIN terms USING (term)
    JOIN lengths USING (document_id, page_number), totals
   GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY query_id ORDER BY round(score, 9) DESC, document_id, page_number) AS rank FROM scored)
SELECT query_id, rank, file_name, page_number, round(score, 3) AS score, document_id, substr(page_text, 1, 300) AS snippet
  FROM ranked JOIN doc_pages USING (document_id, page_number) WHERE rank <= 10"""


# The forms that share the stems of the stemmed query; all other words keep their own form here.
_STEMS = """CASE WHEN term IN ('license', 'licenses', 'licensed', 'licensing') THEN 'licens'
  WHEN term IN ('warranty', 'warranties') THEN 'warranti' ELSE term END"""


def _substring(pattern: str, literal: str | None) -> str:
    """``literal`` is where the snippet starts from; None where the pattern is found by wildcards only."""
    at = f"greatest(1, instr(lower(page_text), lower('{literal}')) - 120)" if literal else "1"
    return f"""WITH {_PAGES}
SELECT file_name, page_number, NULL::VARCHAR AS page_label,
       substr(page_text, {at}, 300) AS snippet, document_id
  FROM doc_pages WHERE page_text ILIKE '%{pattern}%'"""


_SHOWN = f"""WITH {_PAGES}
SELECT file_name, page_number, NULL::VARCHAR AS page_label,
       trim(regexp_replace(
         substr(page_text, greatest(1, instr(lower(page_text), 'the') - 120), 300), '\\s+', ' ', 'g')) AS snippet,
       document_id
  FROM doc_pages WHERE page_text ILIKE '%the%' ORDER BY file_name, page_number, document_id LIMIT 20"""


def _dates() -> str:
    cases = ", ".join(
        f"({-i}, {'NULL' if raw is None else chr(39) + raw.replace(chr(39), chr(39) * 2) + chr(39)})"
        for i, raw in enumerate(DATE_CASES, start=1)
    )
    names = "['y', 'mo', 'd', 'h', 'mi', 's', 'sg', 'oh', 'om']"
    pattern = PDF_DATE_PATTERN.replace("'", "''")
    return f"""WITH given AS (
  SELECT o_orderkey AS date_id,
         'D:' || strftime(o_orderdate, '%Y%m%d%H%M%S')
              || (['Z', '+09''00''', '-05''30''', ''])[o_orderkey % 4 + 1] AS raw FROM orders
  UNION ALL SELECT * FROM (VALUES {cases}) AS c(date_id, raw)),
parts AS (SELECT *, regexp_extract(trim(raw), '{pattern}', {names}) AS m FROM given),
moments AS (
  SELECT *, try_strptime(m.y || coalesce(nullif(m.mo, ''), '01') || coalesce(nullif(m.d, ''), '01')
              || coalesce(nullif(m.h, ''), '00') || coalesce(nullif(m.mi, ''), '00')
              || coalesce(nullif(m.s, ''), '00'), '%Y%m%d%H%M%S') AS moment FROM parts)
SELECT date_id, raw,
       CASE WHEN m.y <> '' THEN epoch_us(moment) END
       - CASE WHEN m.sg IN ('+', '-') AND m.oh <> ''
              THEN (CASE WHEN m.sg = '-' THEN -1 ELSE 1 END) * 60000000::BIGINT
                   * (try_cast(m.oh AS INT) * 60 + coalesce(try_cast(m.om AS INT), 0))
              ELSE 0 END AS parsed_us
  FROM moments"""


def _mime() -> str:
    endings = ", ".join(f"'{e}'" for e in MIXED_ENDINGS)
    return f"""WITH mixed AS (
  SELECT doc_id AS ordinal, ([{endings}])[doc_id % 7 + 1] AS ending,
         CASE WHEN doc_id % 7 = 4 THEN '%PDF-1.7 ' || text ELSE text END AS body FROM documents)
SELECT ordinal, ordinal || ending AS file_name,
       lower(regexp_extract(ending, '([^.]*)$', 1)) AS file_extension,
       CASE ending WHEN '.txt' THEN 'text/plain' WHEN '.PDF' THEN 'application/pdf'
                   WHEN '.tgz' THEN 'application/x-tar' WHEN '.html.gz' THEN 'text/html'
            ELSE CASE WHEN body LIKE '\\%PDF-%' ESCAPE '\\' THEN 'application/pdf'
                      ELSE 'application/octet-stream' END END AS mime_type
  FROM mixed"""


def _nulls() -> str:
    from quire.schemas import CHUNKS, DOCUMENTS, PAGES, required

    rows = [
        f"SELECT '{name}' AS table_name, '{column}' AS column_name, 0::BIGINT AS null_rows"
        for name, schema in (("documents", DOCUMENTS), ("document_chunks", CHUNKS), ("document_pages", PAGES))
        for column in required(schema)
    ]
    return " UNION ALL ".join(rows)


# Visible text of the given web pages: only their tags and character references are handled.
_HTML = r"""WITH shown AS (
  SELECT page_id, regexp_replace(html,
    '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title>.*?</title>|<!--.*?-->|<![^>]*>', '', 'g') AS t
    FROM pages),
cut AS (
  SELECT page_id, regexp_replace(regexp_replace(t,
    '(?i)</?(p|br|div|li|tr|h1|h2|h3|h4|h5|h6|article|section|td|th)(\s[^>]*)?/?>', chr(10), 'g'),
    '<[^>]*>', '', 'g') AS t FROM shown),
plain AS (
  SELECT page_id, regexp_replace(
    replace(replace(replace(t, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS t FROM cut),
lines AS (
  SELECT page_id, list_transform(string_split(t, chr(10)), lambda x:
    trim(regexp_replace(x, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{3000}]+', ' ', 'g'))) AS l FROM plain)
SELECT page_id AS ordinal, 1 AS page_number,
       array_to_string(list_filter(l, lambda x: x <> ''), chr(10)) AS page_text,
       CASE WHEN page_text <> '' THEN 'native' ELSE 'none' END AS extraction_method FROM lines"""

_METHOD = f"CASE WHEN {_NONBLANK} THEN 'native' ELSE 'none' END AS extraction_method"
_SCANNED = f"""{_PATH_PAGES},
scanned AS (
  SELECT document_id, page_number, page_text AS scan, ordinal, (ordinal % 3)::INT AS image_count,
         CASE WHEN ordinal % 7 = 0 THEN '' ELSE page_text END AS page_text FROM path_pages),
candidate AS (SELECT *, NOT {_NONBLANK} AND image_count > 0 AS wanted FROM scanned)
"""
_FULL_REPORT = f"""
  SELECT document_id, (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES} AS chunks,
         (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS pages, length(text) AS chars FROM docs"""


def statements() -> dict[str, str]:
    with_text = f"SELECT document_id, count(*) FILTER (WHERE {_NONBLANK}) AS with_text FROM doc_pages GROUP BY 1"
    return {
        "file_attributes": f"""WITH {_FILES} SELECT ordinal, file_name, file_path, 'txt' AS file_extension,
            file_size_bytes, ({FIRST_MODIFIED} + ordinal * 60) * 1000000 AS file_modified_us FROM files""",
        "content_hash": f"WITH {_FILES} SELECT ordinal, sha256_hex FROM files",
        "document_ids": f"WITH {_FILES} SELECT ordinal, document_id FROM named",
        "page_keys": f"""WITH {_PATH_PAGES} SELECT document_id, page_number,
            document_id || ':' || page_number AS page_id, {_METHOD}, length(page_text) AS char_count FROM path_pages""",
        "mime_guess": _mime(),
        "pdf_date_parse": _dates(),
        "document_info": """SELECT page_id AS ordinal, page_id || '.html' AS file_name, 1 AS page_count,
            'HTML' AS pdf_format, NULL::VARCHAR AS author, false AS is_encrypted, false AS needs_password,
            nullif(trim(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&amp;', '&')), '') AS title
            FROM pages""",
        "extract_pages": f"""WITH {_PATH_PAGES} SELECT ordinal, page_number, {_METHOD},
            length(page_text) AS char_count, page_text FROM path_pages""",
        "extract_pages_capped": f"""WITH {_PATH_PAGES} SELECT ordinal, page_number, {_METHOD},
            length(page_text) AS char_count, page_text FROM path_pages WHERE page_number <= 1""",
        "html_pages": _HTML,
        "max_pages": f"""WITH {_PATH_PAGES} SELECT document_id || ':' || page_number AS page_id, page_number, page_text
            FROM path_pages WHERE page_number <= 2""",
        "not_null_violations": _nulls(),
        "ocr_candidates": f"WITH {_SCANNED} SELECT document_id, page_number, image_count FROM candidate WHERE wanted",
        "ocr_merge": f"""WITH {_SCANNED},
            merged AS (SELECT * EXCLUDE (page_text), wanted AND scan <> '' AS recognised,
                              CASE WHEN wanted THEN scan ELSE page_text END AS page_text FROM candidate)
            SELECT document_id, page_number, page_text, length(page_text) AS char_count,
                   CASE WHEN NOT {_NONBLANK} THEN 'none' WHEN recognised THEN 'ocr' ELSE 'native' END
                     AS extraction_method FROM merged""",
        "chunk_content": f"""WITH {_CHUNKS} SELECT document_id, chunk_index, byte_offset,
            octet_length(piece) AS chunk_length_bytes, hex(piece) AS content_hex FROM doc_chunks""",
        "chunk_fetch": f"""WITH {_CHUNKS} SELECT document_id, chunk_index, hex(piece) AS content_hex
            FROM doc_chunks WHERE file_name = '3.txt' ORDER BY chunk_index""",
        "chunk_verify": f"""WITH {_DOCS} SELECT document_id, sha256_hex, file_size_bytes,
            sha256_hex AS rebuilt_sha256_hex, file_size_bytes AS rebuilt_size_bytes, true AS intact FROM docs""",
        "chunk_gaps": f"""WITH {_CHUNKS}, c AS (SELECT document_id, count(*) AS stored_chunks,
              sum(octet_length(piece))::BIGINT AS stored_bytes FROM doc_chunks GROUP BY 1)
            SELECT document_id, stored_chunks AS expected_chunks, stored_chunks, stored_bytes,
                   stored_bytes = file_size_bytes AS complete FROM docs JOIN c USING (document_id)""",
        "chunk_tree": f"""WITH {_CHUNKS}, leaves AS (SELECT document_id, chunk_index, sha256(piece) AS digest FROM doc_chunks),
            nodes AS (SELECT document_id, chunk_index // {TREE_FANOUT} AS node, count(*) AS n,
                        sha256(string_agg(digest, '' ORDER BY chunk_index)) AS digest FROM leaves GROUP BY 1, 2)
            SELECT document_id, sum(n)::INTEGER AS chunk_count, sha256(string_agg(digest, '' ORDER BY node)) AS content_root,
                   '' AS damaged_chunks, true AS intact FROM nodes GROUP BY document_id""",
        "chunk_order": f"""WITH {_CHUNKS} SELECT document_id, chunk_index, byte_offset,
            coalesce(lag(byte_offset + octet_length(piece)) OVER w, 0) AS expected_offset,
            byte_offset = coalesce(lag(byte_offset + octet_length(piece)) OVER w, 0) AS continues
            FROM doc_chunks WINDOW w AS (PARTITION BY document_id ORDER BY chunk_index)""",
        "migrate_page_id": f"""WITH {_PAGES} SELECT document_id, page_number,
            document_id || ':' || page_number AS page_id FROM doc_pages""",
        "already_loaded": f"""WITH {_DOCS}, kept AS ({_NOT_FRENCH})
            SELECT ordinal, file_path, sha256_hex, document_id AS stored_document_id FROM named
             WHERE sha256_hex IN (SELECT sha256_hex FROM kept)""",
        "load_dedup": f"""WITH {_DOCS}, kept AS ({_NOT_FRENCH})
            SELECT ordinal, file_path, sha256_hex, document_id FROM docs
             WHERE sha256_hex NOT IN (SELECT sha256_hex FROM kept)""",
        "load_replace": f"""WITH {_FILES},
            last AS (SELECT * FROM named
                     QUALIFY row_number() OVER (PARTITION BY sha256_hex ORDER BY ordinal DESC) = 1)
            SELECT document_id, file_name, file_path,
                   (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES} AS chunk_count,
                   (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS live_pages FROM last""",
        "replace_report": f"""WITH {_PAGES}, t AS ({with_text}), r AS ({_FULL_REPORT})
            SELECT ordinal, file_name, document_id, 'loaded' AS status, file_size_bytes, chunks AS chunk_count,
                   pages AS page_count, coalesce(with_text, 0) AS pages_with_text, 0 AS pages_ocr,
                   0 AS pages_needing_ocr, chars AS total_text_chars, false AS hidden_layers_revealed
              FROM named JOIN r USING (document_id) LEFT JOIN t USING (document_id)""",
        "file_scan": """WITH listing AS (
              SELECT '/mixed/' || doc_id || ['.txt', '.PDF', '', '.q9', '', '.tgz', '.html.gz'][doc_id % 7 + 1] AS file_path,
                     doc_id || ['.txt', '.PDF', '', '.q9', '', '.tgz', '.html.gz'][doc_id % 7 + 1] AS file_name,
                     strlen(CASE WHEN doc_id % 7 = 4 THEN '%PDF-1.7 ' || text ELSE text END) AS file_size_bytes FROM documents),
            given AS (SELECT unnest([0, 1, 2, 3])::INTEGER AS given, unnest(['/mixed/10.q9', '/mixed/1.PDF', '/mixed/2', '/mixed/10.q9']) AS file_path)
            SELECT given, file_path, file_name, file_size_bytes FROM listing JOIN given USING (file_path)
            UNION ALL SELECT NULL, file_path, file_name, file_size_bytes FROM listing WHERE lower(file_name) LIKE '%.pdf'""",
        "load_failures": """WITH f AS (
              SELECT doc_id AS ordinal, text, doc_id % 50 = 7 AS unread FROM documents),
            w AS (SELECT text, min(ordinal) FILTER (WHERE NOT unread) AS first FROM f GROUP BY 1)
            SELECT ordinal, CASE WHEN unread OR contains(text, 'License') THEN 'failed'
                WHEN ordinal = first THEN 'loaded' ELSE 'skipped' END AS status,
                CASE WHEN unread THEN 'ValueError: damaged' WHEN contains(text, 'License') THEN 'ValueError: unreadable page' END AS error
              FROM f JOIN w USING (text)""",
        "load_report": f"""WITH {_PAGES}, t AS ({with_text}), r AS ({_FULL_REPORT}),
            firsts AS (SELECT ordinal, true AS is_first FROM docs)
            SELECT ordinal, file_name, document_id,
                   CASE WHEN is_first THEN 'loaded' ELSE 'skipped' END AS status, file_size_bytes,
                   CASE WHEN is_first THEN chunks ELSE 0 END AS chunk_count, pages AS page_count,
                   CASE WHEN is_first THEN coalesce(with_text, 0) ELSE 0 END AS pages_with_text, 0 AS pages_ocr,
                   0 AS pages_needing_ocr, CASE WHEN is_first THEN chars ELSE 0 END AS total_text_chars, false AS hidden_layers_revealed
              FROM named JOIN r USING (document_id) LEFT JOIN t USING (document_id)
              LEFT JOIN firsts USING (ordinal)""",
        "delete_document": _table_counts(_NOT_FRENCH),
        "load_tables": _table_counts(_ALL),
        "stream_ingest": _table_counts(_ALL),
        "document_rollup": f"""WITH {_PAGES}, t AS ({with_text})
            SELECT document_id, file_name, file_size_bytes, sha256_hex, 'text/plain' AS mime_type,
                   (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS page_count,
                   (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES} AS chunk_count,
                   coalesce(with_text, 0) AS pages_with_text, 0 AS pages_ocr, length(text) AS total_text_chars
              FROM docs LEFT JOIN t USING (document_id)""",
        "dry_run_summary": f"""WITH {_PATH_PAGES}, t AS (
              SELECT ordinal, count(*) FILTER (WHERE {_NONBLANK}) AS pages_with_text FROM path_pages GROUP BY 1)
            SELECT ordinal, file_name, file_size_bytes,
                   (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS page_count,
                   coalesce(pages_with_text, 0) AS pages_with_text, 0 AS pages_ocr, length(text) AS total_text_chars
              FROM files LEFT JOIN t USING (ordinal)""",
        "document_metadata": f"""WITH {_PAGES}, t AS ({with_text})
            SELECT file_name, 'text/plain' AS mime_type, file_size_bytes,
                   (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS page_count,
                   coalesce(with_text, 0) AS pages_with_text, NULL::VARCHAR AS title, NULL::VARCHAR AS producer,
                   NULL::BIGINT AS pdf_created_us FROM docs LEFT JOIN t USING (document_id)""",
        "list_documents": f"""WITH {_PAGES}, t AS ({with_text})
            SELECT file_name, file_size_bytes, (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS page_count,
                   coalesce(with_text, 0) AS pages_with_text, length(text) AS total_text_chars,
                   (file_size_bytes + {CHUNK_BYTES - 1}) // {CHUNK_BYTES} AS chunk_count,
                   false AS hidden_layers_revealed, document_id
              FROM docs LEFT JOIN t USING (document_id) ORDER BY file_name, document_id""",
        "search_substring": _substring(SUBSTRING, SUBSTRING),
        "search_wildcard": _substring(WILDCARD, None),
        "search_substring_grams": _substring(SUBSTRING, SUBSTRING),
        "search_wildcard_grams": _substring(WILDCARD, None),
        "search_shown": _SHOWN,
        "sql_search_pages": _substring(WILDCARD, None),
        "sql_document_text": f"""WITH {_PAGES} SELECT document_id, file_name,
            sha256(string_agg(page_text, chr(12) ORDER BY page_number)) AS text_sha256 FROM doc_pages GROUP BY ALL""",
        "null_rows": """WITH r AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
            SELECT unnest(['doc_id', 'text', 'lang', 'quality', 'toxic']) AS column_name,
                   unnest([count(*) - count(doc_id), count(*) - count(text), count(*) - count(lang),
                           count(*) - count(quality), count(*) - count(toxic)]) AS null_rows FROM r""",
        "chunk_fetch_long": f"""WITH {_CHUNKS} SELECT document_id, chunk_index, sha256(piece) AS content_sha256
            FROM doc_chunks WHERE file_name = (SELECT file_name FROM docs ORDER BY file_size_bytes DESC, file_name LIMIT 1)""",
        "document_text": f"""WITH {_PAGES} SELECT document_id, file_name, NULL::VARCHAR AS title,
            (length(text) + {PAGE_CHARS - 1}) // {PAGE_CHARS} AS page_count,
            string_agg(page_text, chr(12) ORDER BY page_number) AS document_text
            FROM doc_pages GROUP BY ALL""",
        "tokenize_pages": f"""WITH {_PATH_PAGES}, cut AS (
              SELECT document_id || ':' || page_number AS page_id,
                     list_filter({_SPLIT.format('page_text')}, lambda w: w <> '') AS words FROM path_pages)
            SELECT page_id, len(words) AS n_tokens, array_to_string(words, ' ') AS tokens FROM cut""",
        "index_postings": f"""WITH {_PAGES}, {_index()} SELECT document_id || ':' || page_number AS page_id,
            term, tf, page_len FROM postings JOIN lengths USING (document_id, page_number)""",
        "index_terms": f"WITH {_PAGES}, {_index()} SELECT * FROM terms",
        "index_stats": f"""WITH {_PAGES}, {_index()} SELECT n_pages, (SELECT count(*) FROM terms) AS n_terms,
            (SELECT sum(tf)::BIGINT FROM postings) AS n_tokens, round(avg_len, 6) AS avg_len FROM totals""",
        "index_copy": f"""WITH {_PAGES} SELECT document_id || ':' || page_number AS page_id, document_id,
            page_number, page_text FROM doc_pages""",
        "search_ranked": _ranked(RANKED, 20),
        "search_ranked_segments": _ranked(RANKED, 20),
        "search_ranked_streamed": _ranked(RANKED, 20),
        "sql_search_ranked": _ranked(RANKED, 20),
        "segment_terms": f"WITH {_PAGES}, {_index()} SELECT * FROM terms",
        "search_ranked_all_terms": _ranked(ALL_TERMS, 10, all_terms=True, decimals=2),
        "search_ranked_stemmed": _ranked(
            "licens warranti", 20, form=_STEMS, left_out=", ".join(f"'{w}'" for w in STOP_WORDS)
        ),
        "search_ranked_batch": _BATCH,
        "index_staleness": _ranked("la de license", 30, live=_NOT_FRENCH),
    }
