"""BM25-ranked search over the segments of an index (``segments`` tells how they are stored and written).

Document frequencies and lengths are those of the segments taken together at query time;
each page is in one segment. Postings are stored in lists, one for each term of a block of pages.
``page_len`` rides along with them, so scoring joins nothing, and ``doc_key`` is the document id in
16 bytes. A query reads only the buckets and row groups of its own terms.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import identity, text, tokens
from quire.functions.stemmer import stem_arrays, stem_english
from quire.session import shared_dir, spread

# The customary BM25 parameters and result size.
BM25_K = 1.2
BM25_B = 0.75
TOP_K = 20

# Scores are compared at this many decimals, as the order of a sum leaves noise beyond it.
SCORE_DECIMALS = 9
# Up to this many result rows, their keys are sent as literals so the page scan can skip files.
LITERAL_KEYS = 200
# Values per IN list that Parquet checks one by one (spark.sql.parquet.pushdown.inFilterThreshold).
IN_LIST = 10

# Batch search: plain scoring makes at most this many (query, page) pairs.
DIRECT_PAIRS = 5_000_000
# At most this many asked terms are broadcast (some tens of bytes each).
BROADCAST_ROWS = 100_000
SALTS = 32
# Largest k that Spark trims groups to before a shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_LIMIT = 1000
# Far above the noise of sums and the rounding of compared scores.
TIE_MARGIN = 1e-6
# Term sets that are scored together, and pages of a block at a time: bounds a worker's matrices.
SETS_AT_ONCE = 512
PAGES_AT_ONCE = 512

PAGES_PER_BUCKET = 1_000_000
MIN_BUCKETS, MAX_BUCKETS = 8, 32_768

PAGE_KEY = ["doc_key", "page_number"]

#: Tokens, or postings, that a task packs at a time; a page with more comes alone.
BLOCK_TOKENS = 2_000_000
KEY_BYTES = 16

#: One row per term and block: the document keys of its pages, their numbers, frequencies and lengths, and sums of these.
LISTS = (
    "block long, term string, doc_keys array<binary>, page_number array<int>, tf array<int>, page_len array<int>, "
    "df int, total_tf long, max_tf int, min_len int"
)
POSTINGS = f"{LISTS}, bucket int"
#: Lists of one bucket on their way to the task that writes them: a page's key, number and length once, compressed.
PARCELS = "bucket int, task int, parcel binary"
PAGE_BYTES = KEY_BYTES + 8
#: Pages for each task that writes postings: one of 8 buckets has those of 20,000 pages in a file, whose keys a dictionary holds.
PAGES_PER_TASK = 2_500
TERMS = "term string, df long, total_tf long, max_tf int, min_len int, bucket int"


def tokenize_pages(
    pages: DataFrame, stop_words: list[str] | None = None, stemmer: str | None = None
) -> DataFrame:
    """Add ``tokens`` to page rows: one array per page, in reading order."""
    words = tokens.remove_stop_words(tokens.tokens(F.col("page_text")), stop_words or [])
    out = pages.withColumn("tokens", F.coalesce(words, F.array().cast("array<string>")))
    if check_stemmer(stemmer) == "english":
        out = out.withColumn("tokens", stem_arrays("tokens"))
    return out


def check_stemmer(stemmer: str | None) -> str:
    name = stemmer or "none"
    if name not in ("english", "none"):
        raise ValueError(f"unknown stemmer {stemmer!r}")
    return name


def page_postings(
    pages: DataFrame, stop_words: list[str] | None = None, stemmer: str | None = None
) -> DataFrame:
    """``LISTS``: each task packs the postings of its pages block by block; no shuffle.

    All postings of a page are in one block.
    """
    return _cut_pages(pages, stop_words, stemmer).mapInArrow(_page_lists, LISTS)


def page_parcels(pages: DataFrame, stop_words: list[str], stemmer: str | None, buckets: int, parts: int) -> DataFrame:
    """The lists of ``page_postings`` as ``PARCELS``."""
    return _cut_pages(pages, stop_words, stemmer).mapInArrow(lambda batches: _page_parcels(batches, buckets, parts), PARCELS)


def _cut_pages(pages: DataFrame, stop_words: list[str] | None, stemmer: str | None) -> DataFrame:
    cut = tokenize_pages(
        spread(pages.select("document_id", "page_number", "page_text")), stop_words, stemmer
    )
    return cut.select(identity.document_key(F.col("document_id")).alias("doc_key"), "page_number", "tokens")


def _page_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, terms, codes, page, tf, keys, numbers, length in _blocks(batches):
        yield _lists(np.full(len(codes), block), terms, codes, keys[page], numbers[page], tf, length[page])


def _page_parcels(batches: Iterator[pa.RecordBatch], buckets: int, parts: int) -> Iterator[pa.RecordBatch]:
    for block, terms, codes, page, tf, *pages in _blocks(batches):
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        sizes = np.diff(np.append(first, len(codes)))
        yield _seal(np.full(len(first), block), terms.take(pa.array(codes[first])), sizes, page, tf, _page_rows(*pages), buckets, parts)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each block its number and terms; by term the code, page and frequency of its postings; its pages' keys, numbers and lengths."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK_TOKENS, side="right")))
            keys, numbers, lists = batch.slice(at, n).columns
            length, at = sizes[at : at + n].astype(np.int64), at + n
            words = lists.flatten().dictionary_encode()
            if not len(words):
                continue
            # One number for each (term, page); equal ones are its frequency.
            pairs = words.indices.to_numpy().astype(np.int64) * n + np.repeat(np.arange(n), length)
            pairs, tf = np.unique(pairs, return_counts=True)
            codes, page = np.divmod(pairs, n)
            keys, numbers = _key_bytes(keys), numbers.to_numpy(zero_copy_only=False)
            block = zlib.crc32(keys[0].tobytes() + bytes(numbers[:1]))
            yield block, words.dictionary, codes, page, tf, keys, numbers, length


def _key_bytes(keys: pa.Array) -> np.ndarray:
    """Document keys as rows of ``KEY_BYTES`` bytes."""
    fixed = keys.cast(pa.binary(KEY_BYTES))
    return np.frombuffer(fixed.buffers()[1], np.uint8, len(fixed) * KEY_BYTES, fixed.offset * KEY_BYTES).reshape(-1, KEY_BYTES)


def _lists(block, terms: pa.Array, codes, keys, numbers, tf, length) -> pa.RecordBatch:
    """One row for each run of postings of the same block and term, which ``codes`` number."""
    first = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])))
    ends = pa.array(np.append(first, len(codes)).astype(np.int32))
    listed = lambda values: pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))
    starts = np.arange(len(codes) + 1, dtype=np.int32) * KEY_BYTES
    binary = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(keys))])
    packed = pa.ListArray.from_arrays(ends, binary)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block[first].astype(np.int64)), terms.take(pa.array(codes[first])), packed, listed(numbers), listed(tf), listed(length),
            pa.array(np.diff(np.append(first, len(codes))).astype(np.int32)), pa.array(np.add.reduceat(tf, first).astype(np.int64)),
            pa.array(np.maximum.reduceat(tf, first).astype(np.int32)), pa.array(np.minimum.reduceat(length, first).astype(np.int32)),
        ],
        [field.split()[0] for field in LISTS.split(", ")],
    )


def pack(postings: DataFrame) -> DataFrame:
    """``LISTS`` of postings one by one (block, term, doc_key, page_number, tf, page_len), in the order they come."""

    def lists(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        words = rows.column("term").combine_chunks().dictionary_encode()
        codes, block, numbers, tf, length = (
            x.to_numpy(zero_copy_only=False).astype(np.int64)
            for x in (words.indices, *(rows.column(c).combine_chunks() for c in ("block", "page_number", "tf", "page_len")))
        )
        order = np.lexsort((codes, block))
        keys = _key_bytes(rows.column("doc_key").combine_chunks())
        return _lists(block[order], words.dictionary, codes[order], keys[order], numbers[order], tf[order], length[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= BLOCK_TOKENS:
                yield lists(held)
                held, n = [], 0
        if held:
            yield lists(held)

    return postings.select("block", "term", *PAGE_KEY, "tf", "page_len").mapInArrow(run, LISTS)


def parcels(lists: DataFrame, buckets: int, parts: int) -> DataFrame:
    """``LISTS`` as ``PARCELS``."""
    return lists.select(*[field.split()[0] for field in LISTS.split(", ")]).mapInArrow(lambda batches: _parcels(batches, buckets, parts), PARCELS)


def bucket_parts(n_pages: int, buckets: int) -> int:
    """Tasks that write a bucket of the postings of so many pages."""
    return max(1, math.ceil(n_pages / (PAGES_PER_TASK * buckets)))


def deliver(rows: DataFrame, buckets: int, parts: int) -> DataFrame:
    """``POSTINGS`` of ``PARCELS``: each bucket is dealt over ``parts`` tasks by where its parcels come from, so a hot term is no hot task."""
    return rows.repartitionById(buckets * parts, F.col("task")).mapInArrow(_unpacked_parcels, POSTINGS)


def _parcels(batches: Iterator[pa.RecordBatch], buckets: int, parts: int) -> Iterator[pa.RecordBatch]:
    """One parcel for each bucket of some ``BLOCK_TOKENS`` postings."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += pc.sum(batch.column("df")).as_py()
        if n >= BLOCK_TOKENS:
            yield _seal(*_coded(held), buckets, parts)
            held, n = [], 0
    if held:
        yield _seal(*_coded(held), buckets, parts)


def _coded(held: list[pa.RecordBatch]) -> tuple:
    """Lists with numbers of pages in place of their keys: blocks, terms, sizes, pages, frequencies, and the pages."""
    lists = pa.Table.from_batches(held).combine_chunks()
    block, term, sizes = (lists.column(c).combine_chunks() for c in ("block", "term", "df"))
    keys = _key_bytes(pc.list_flatten(lists.column("doc_keys")).combine_chunks())
    known = _page_rows(keys, _flat(lists.column("page_number")), _flat(lists.column("page_len"))).dictionary_encode()
    return block.to_numpy(), term, sizes.to_numpy(), known.indices.to_numpy(), _flat(lists.column("tf")), known.dictionary


def _page_rows(keys: np.ndarray, numbers: np.ndarray, length: np.ndarray) -> pa.Array:
    rows = np.hstack([keys, *(x.astype(np.int32).view(np.uint8).reshape(-1, 4) for x in (numbers, length))])
    return pa.Array.from_buffers(pa.binary(PAGE_BYTES), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])


def _seal(block, term: pa.Array, sizes, page, tf, known: pa.Array, buckets: int, parts: int) -> pa.RecordBatch:
    # By the partition alone: a task that runs again may get its rows in another order, but sends them to the same tasks.
    part = TaskContext.get().partitionId() % parts
    words = term.dictionary_encode()
    bucket = np.array([zlib.crc32(w.encode()) % buckets for w in words.dictionary.to_pylist()])[words.indices.to_numpy()]
    starts, tf = np.cumsum(sizes) - sizes, tf.astype(np.int32)

    out = []
    for number in np.unique(bucket):
        rows = np.flatnonzero(bucket == number)
        size = sizes[rows].astype(np.int32)
        at = np.repeat(starts[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        here = np.zeros(len(known), bool)
        here[page[at]] = True
        columns = {
            "block": pa.array(block[rows]), "term": term.take(pa.array(rows)), "size": pa.array(size),
            # Pages of a list come in order, so their differences are small.
            "page": pa.array(np.diff((np.cumsum(here) - 1)[page[at]], prepend=0).astype(np.int32)),
            "tf": pa.array(tf[at]), "pages": known.take(pa.array(np.flatnonzero(here))),
        }
        row = pa.record_batch([pa.ListArray.from_arrays([0, len(c)], c) for c in columns.values()], names=list(columns))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(row)
        out.append((int(number), int(number) * parts + part, sink.getvalue().to_pybytes()))
    return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "task", "parcel"])


def _unpacked_parcels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, parcel in zip(batch.column("bucket").to_pylist(), batch.column("parcel"), strict=True):
            rows = pa.ipc.open_stream(parcel.as_buffer()).read_all()
            block, term, size, page, tf, pages = (pc.list_flatten(rows.column(c)).combine_chunks() for c in ("block", "term", "size", "page", "tf", "pages"))
            size = size.to_numpy()
            known = np.frombuffer(pages.buffers()[1], np.uint8, len(pages) * PAGE_BYTES, pages.offset * PAGE_BYTES).reshape(-1, PAGE_BYTES)
            known = known[np.cumsum(page.to_numpy())]
            numbers, length = np.ascontiguousarray(known[:, KEY_BYTES:]).view(np.int32).T
            lists = _lists(np.repeat(block.to_numpy(), size), term, np.repeat(np.arange(len(size)), size), known[:, :KEY_BYTES], numbers, tf.to_numpy(), length)
            yield lists.append_column("bucket", pa.array(np.full(lists.num_rows, bucket, np.int32)))


def unpack(lists: DataFrame) -> DataFrame:
    """``lists`` with one row for each posting: doc_key, page_number, tf, page_len instead of the packed columns."""
    packed = ["doc_keys", "page_number", "tf", "page_len"]
    kept = [c for c in lists.columns if c not in (*packed, "df", "total_tf", "max_tf", "min_len")]
    rows = lists.select(*kept, "doc_keys", "tf", "page_len", F.posexplode("page_number").alias("_at", "_number"))
    return rows.select(
        *kept, F.get("doc_keys", F.col("_at")).alias("doc_key"),
        F.col("_number").alias("page_number"), F.get("tf", F.col("_at")).alias("tf"), F.get("page_len", F.col("_at")).alias("page_len"),
    )


def bucket_of(term: Column, buckets: int) -> Column:
    return (F.crc32(F.encode(term, "UTF-8")) % buckets).cast("int")


def term_statistics(lists: DataFrame) -> DataFrame:
    """Per term: pages holding it, occurrences, and the bounds that its weight cannot pass."""
    return lists.groupBy("bucket", "term").agg(
        F.sum("df").alias("df"),
        F.sum("total_tf").alias("total_tf"),
        F.max("max_tf").alias("max_tf"),
        F.min("min_len").alias("min_len"),
    )


def idf(df: Column, n_pages: Column) -> Column:
    return F.log10((n_pages - df + 0.5) / (df + 0.5) + 1)


def tf_weight(tf: Column, page_len: Column, avg_len: Column, k: float = BM25_K, b: float = BM25_B) -> Column:
    return tf * (k + 1) / (tf + k * (1 - b + b * page_len / avg_len))


@dataclass(frozen=True)
class Totals:
    """Sums over the segments of an index, and what they share."""

    n_pages: int
    n_tokens: int
    buckets: int
    stemmer: str

    @property
    def avg_len(self) -> float | None:
        return self.n_tokens / self.n_pages if self.n_pages else None


@dataclass(frozen=True)
class SearchIndex:
    """One version of an index in the folder ``base``; its few rows of settings are read once."""

    spark: SparkSession
    base: str
    path: str

    @cached_property
    def segments(self) -> list:
        """One row per segment, oldest first."""
        return self.spark.read.parquet(f"{self.path}/segments").orderBy("segment").collect()

    @cached_property
    def loads(self) -> dict[str, str]:
        """The segment of every load that is indexed."""
        return {row.load_id: row.segment for row in self.spark.read.parquet(f"{self.path}/loads").collect()}

    @property
    def dead(self) -> DataFrame:
        """(segment, doc_key): documents whose rows in a segment are dead."""
        return self.spark.read.parquet(f"{self.path}/dead")

    @property
    def n_dead(self) -> int:
        return sum(row.n_dead for row in self.segments)

    def _rows(self, table: str, schema: str) -> DataFrame:
        folders = [f"{self.base}/{table}/segment={row.segment}" for row in self.segments]
        reader = self.spark.read.option("basePath", f"{self.base}/{table}").schema(f"{schema}, segment string")
        return reader.parquet(*folders)

    @property
    def lists(self) -> DataFrame:
        """Posting lists as stored, those of dead documents included."""
        return self._rows("postings", POSTINGS)

    @property
    def postings(self) -> DataFrame:
        """Living postings of all segments; joined with the dead documents only if there are any."""
        return self.living(self.lists)

    def living(self, lists: DataFrame) -> DataFrame:
        """The living postings of lists, one by one."""
        rows = unpack(lists)
        return rows.join(self.dead, ["segment", "doc_key"], "left_anti") if self.n_dead else rows

    @property
    def terms(self) -> DataFrame:
        """Statistics per term over all segments. Documents that died since a segment was written count in them."""
        return self._rows("terms", TERMS).groupBy("bucket", "term").agg(
            F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf"),
            F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"),
        )

    @property
    def pages(self) -> DataFrame:
        """The copied page text of all segments."""
        return self._rows("pages", "page_id string, document_id string, page_number int, page_text string")

    @property
    def stats(self) -> DataFrame:
        """One row: n_pages, n_terms, n_tokens, avg_len."""
        known = self.settings
        return self.terms.agg(F.count("*").alias("n_terms")).select(
            F.lit(known.n_pages).cast("long").alias("n_pages"), "n_terms", F.lit(known.n_tokens).cast("long").alias("n_tokens"),
            F.lit(known.avg_len).cast("double").alias("avg_len"),
        )

    @cached_property
    def settings(self) -> Totals:
        rows = self.segments
        return Totals(sum(r.n_pages for r in rows), sum(r.n_tokens for r in rows), rows[0].buckets, rows[0].stemmer)

    def query_terms(self, query: str) -> list[str]:
        """Distinct index terms of a query text, by the same rules as the pages."""
        source, target = tokens._accent_table()
        table = {ord(c): (target[i] if i < len(target) else None) for i, c in enumerate(source)}
        words = [w for w in re.split(tokens.SEPARATOR, query.lower().translate(table)) if w]
        if self.settings.stemmer == "english":
            words = [stem_english(w) for w in words]
        return list(dict.fromkeys(words))

    def only_buckets(self, table: DataFrame, rows: DataFrame) -> DataFrame:
        """Rows in the buckets of ``rows``, as literals that prune folders; at most ``MAX_BUCKETS`` numbers."""
        return table.where(F.col("bucket").isin(sorted(row[0] for row in rows.select("bucket").distinct().collect())))

    def only_terms(self, table: DataFrame, terms: list[str]) -> DataFrame:
        """Rows of these terms, by literals that prune folders and row groups."""
        buckets = sorted({zlib.crc32(t.encode()) % self.settings.buckets for t in terms})
        return table.where(F.col("bucket").isin(buckets) & any_of("term", terms))


def any_of(column: str, values: list) -> Column:
    """``column IN values`` in the form that Parquet can use for skipping.

    Lists of more than ten values reach the scan as a mere range, which tells nothing about
    random ids. Lists of ten, joined by OR, are checked against statistics and Bloom filters.
    """
    groups = [F.col(column).isin(values[i:i + IN_LIST]) for i in range(0, len(values), IN_LIST)]
    while len(groups) > 1:
        pairs = [groups[i:i + 2] for i in range(0, len(groups), 2)]
        groups = [pair[0] | pair[1] if len(pair) == 2 else pair[0] for pair in pairs]
    return groups[0] if groups else F.lit(False)


def bucket_count(n_pages: int) -> int:
    return max(MIN_BUCKETS, min(MAX_BUCKETS, -(-n_pages // PAGES_PER_BUCKET)))


def query_weights(index: SearchIndex, query: str) -> tuple[list[str], dict[str, tuple]]:
    """The query's distinct terms, and those in the index with (df, idf, max_tf, min_len)."""
    wanted, n_pages = index.query_terms(query), index.settings.n_pages
    if not wanted or not n_pages:
        return wanted, {}
    rows = index.only_terms(index.terms, wanted).select("term", "df", "max_tf", "min_len").collect()
    return wanted, {
        row.term: (row.df, math.log10((n_pages - row.df + 0.5) / (row.df + 0.5) + 1), row.max_tf, row.min_len)
        for row in rows
    }


def score_pages(
    index: SearchIndex,
    query: str,
    all_terms: bool = False,
    k: float = BM25_K,
    b: float = BM25_B,
    best: int | None = None,
    live: LiveCheck | None = None,
    direct_pairs: int = DIRECT_PAIRS,
) -> DataFrame:
    """(doc_key, page_number, score) of the pages holding any (or all) of the query's terms.

    The few query terms and their df become literals, so this is one filtered scan of
    postings, one aggregate, and no join. If only the ``best`` pages are wanted and the terms
    are on more than ``direct_pairs`` pages, blocks are scored whole and hand on their best ones.
    """
    wanted, found = query_weights(index, query)
    if not found or (all_terms and len(found) < len(wanted)):
        return index.spark.createDataFrame([], "doc_key binary, page_number int, score double")
    avg_len = F.lit(float(index.settings.avg_len))
    weight = tf_weight(F.col("tf"), F.col("page_len"), avg_len, k, b)
    if best is not None and sum(values[0] for values in found.values()) > direct_pairs:
        asked = index.spark.createDataFrame(
            [(0, len(wanted), t, values[1]) for t, values in found.items()], "set_no long, n_terms int, term string, idf double"
        ).withColumn("bucket", bucket_of(F.col("term"), index.settings.buckets))
        scoring = _Scoring(index, weight, live, index.only_terms(index.lists, sorted(found)))
        scored = scoring.best_scores(asked, best, all_terms, k, b)
    else:
        weights = F.create_map(*[F.lit(v) for t, values in found.items() for v in (t, values[1])])
        scored = index.living(index.only_terms(index.lists, sorted(found))).select(
            *PAGE_KEY, (F.element_at(weights, F.col("term")) * weight).alias("score")
        )
        if len(found) > 1:
            scored = scored.groupBy(*PAGE_KEY).agg(F.sum("score").alias("score"), F.count("*").alias("matched"))
        else:
            scored = scored.withColumn("matched", F.lit(1))
        scored = _only_live(scored, live)
        if all_terms:
            scored = scored.where(F.col("matched") == len(wanted))
    return scored.select(*PAGE_KEY, "score")


def best_first() -> list[Column]:
    return [F.round("score", SCORE_DECIMALS).desc(), F.col("doc_key"), F.col("page_number")]


def search_ranked(
    index: SearchIndex,
    documents: DataFrame,
    pages: DataFrame,
    query: str,
    top_k: int = TOP_K,
    all_terms: bool = False,
    live: LiveCheck | None = None,
    **parameters: float,
) -> DataFrame:
    """The ``top_k`` best pages: file_name, page_number, score, snippet, document_id.

    The index is a snapshot. ``live`` drops its rows of pages that are gone, before the cut, so
    that they take no result's place; None says that none are gone.
    """
    scored = score_pages(index, query, all_terms, best=top_k, live=live, **parameters)
    top = with_document_id(scored.orderBy(*best_first()).limit(top_k))
    return with_page_heads(top, documents, pages, top_k).orderBy(*best_first()).select(
        "file_name", "page_number", F.round("score", 3).alias("score"), "snippet", "document_id"
    )


@dataclass(frozen=True)
class LiveCheck:
    """Which index rows still stand for a page.

    ``pages`` (document_id, page_number): the pages that are alive; with ``changed`` (distinct
    document_id) only those of documents that were replaced or deleted since the index was
    built. Rows of all other documents then pass without being looked up among all pages.
    """

    pages: DataFrame
    changed: DataFrame | None = None

    def keep(self, scored: DataFrame) -> DataFrame:
        key = identity.document_key(F.col("document_id")).alias("doc_key")
        alive = self.pages.select(key, "page_number")
        if self.changed is None:
            return scored.join(alive, PAGE_KEY, "left_semi")
        changed = self.changed.select(key, F.lit(True).alias("_changed"))
        marked = scored.join(changed, "doc_key", "left").join(
            alive.withColumn("_alive", F.lit(True)), PAGE_KEY, "left"
        )
        return marked.where(F.col("_changed").isNull() | F.col("_alive")).drop("_changed", "_alive")


def _only_live(scored: DataFrame, live: LiveCheck | None) -> DataFrame:
    return scored if live is None else live.keep(scored)


def with_document_id(scored: DataFrame) -> DataFrame:
    return scored.withColumn("document_id", identity.document_of_key(F.col("doc_key")))


def with_page_heads(top: DataFrame, documents: DataFrame, pages: DataFrame, top_k: int) -> DataFrame:
    """Add file name and leading snippet to at most ``top_k`` scored pages.

    For a small ``top_k`` the page keys are known values: as literals they reach the Parquet
    scan, which skips all row groups that cannot hold them and so reads next to no page text.
    """
    if top_k <= LITERAL_KEYS:
        rows = top.collect()
        top = top.sparkSession.createDataFrame(rows, top.schema)
        ids = sorted({row.document_id for row in rows})
        documents = documents.where(any_of("document_id", ids))
        pages = pages.where(any_of("document_id", ids))
    heads = pages.select(
        "document_id", "page_number", text.snippet_head(F.col("page_text")).alias("snippet")
    )
    return heads.join(top, ["document_id", "page_number"]).join(documents.select("document_id", "file_name"), "document_id")


# ``search_ranked`` for SQL, by views of the store and its index. Arguments are literals or expressions
# without columns; the few asked terms are joined, which prunes folders at run time.
SEARCH_TERMS_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION {prefix}search_terms(content STRING) RETURNS ARRAY<STRING> RETURN {terms}
"""
SEARCH_RANKED_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION {prefix}search_pages_ranked(query STRING, top_k INT DEFAULT {top_k})
RETURNS TABLE (file_name STRING, page_number INT, score DOUBLE, snippet STRING, document_id STRING)
RETURN
  WITH given AS (SELECT {prefix}search_terms({prefix}search_pages_ranked.query) AS terms),
  words AS (SELECT DISTINCT term FROM (SELECT explode(terms) AS term FROM given)),
  asked AS (SELECT term, CAST(crc32(encode(term, 'UTF-8')) % {buckets} AS INT) AS bucket FROM words),
  weighed AS (
    SELECT t.bucket, t.term, log10(({n_pages} - t.df + 0.5) / (t.df + 0.5) + 1) AS idf
    FROM {prefix}index_terms t JOIN asked a ON a.bucket = t.bucket AND a.term = t.term),
  scored AS (
    SELECT p.document_id, p.doc_key, p.page_number,
      sum(w.idf * (p.tf * ({k} + 1) / (p.tf + {k} * (1 - {b} + {b} * p.page_len / {avg_len})))) AS score
    FROM {prefix}index_postings p JOIN weighed w ON w.bucket = p.bucket AND w.term = p.term
    GROUP BY p.document_id, p.doc_key, p.page_number),
  ranked AS (SELECT *, row_number() OVER (ORDER BY round(score, {decimals}) DESC, doc_key, page_number) AS place FROM scored)
  SELECT d.file_name, r.page_number, round(r.score, 3), substr(p.page_text, 1, {chars}), r.document_id
  FROM ranked r
    JOIN {prefix}document_pages p ON p.document_id = r.document_id AND p.page_number = r.page_number
    JOIN {prefix}documents d ON d.document_id = r.document_id
  WHERE r.place <= {prefix}search_pages_ranked.top_k
  ORDER BY r.place
"""


def register_ranked_sql(index: SearchIndex, live: LiveCheck | None, prefix: str) -> None:
    """Views ``index_terms`` and ``index_postings``, and the functions ``search_terms`` and ``search_pages_ranked``.

    The views ``documents`` and ``document_pages`` with the same prefix exist. ``search_terms`` gives the index
    terms of a text, repeated ones included; stemming is one Python function on the words of the query.
    """
    spark, known = index.spark, index.settings
    index.terms.createOrReplaceTempView(f"{prefix}index_terms")
    with_document_id(_only_live(index.postings, live)).createOrReplaceTempView(f"{prefix}index_postings")
    terms = tokens.terms_sql("content")
    if known.stemmer == "english":
        spark.udf.register(f"{prefix}search_stems", lambda words: [stem_english(w) for w in words or []], "array<string>")
        terms = f"{prefix}search_stems({terms})"
    spark.sql(SEARCH_TERMS_SQL.format(prefix=prefix, terms=terms))
    spark.sql(SEARCH_RANKED_SQL.format(
        prefix=prefix, top_k=TOP_K, buckets=known.buckets, n_pages=known.n_pages, k=BM25_K, b=BM25_B,
        avg_len=f"CAST({known.avg_len or 1.0!r} AS DOUBLE)", decimals=SCORE_DECIMALS, chars=text.SNIPPET_CHARS,
    ))


# --- many queries at once ---------------------------------------------------------------


def query_term_sets(index: SearchIndex, queries: DataFrame) -> DataFrame:
    """(query_id, query) -> (query_id, terms_key, n_terms): the distinct index terms, sorted and joined."""
    words = F.coalesce(tokens.tokens(F.col("query")), F.array().cast("array<string>"))
    out = queries.withColumn("_words", words)
    if index.settings.stemmer == "english":
        out = out.withColumn("_words", stem_arrays("_words"))
    terms = F.array_sort(F.array_distinct("_words"))
    out = out.withColumn("_terms", terms)
    return out.select("query_id", F.array_join("_terms", " ").alias("terms_key"), F.size("_terms").alias("n_terms"))


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, with ``rank``. Exact, and no group meets in one task whole.

    Up to ``MAP_SIDE_LIMIT`` Spark itself trims every group to k rows in each task before the
    shuffle (WindowGroupLimit). Beyond that each group is first cut to k within ``SALTS`` hash
    parts, so the final ranking sees at most k x SALTS rows of a group.
    """
    if k > MAP_SIDE_LIMIT:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in PAGE_KEY]), F.lit(SALTS)).alias("_part")
        within = Window.partitionBy(*group, "_part").orderBy(*order)
        numbered = rows.select("*", part).withColumn("_n", F.row_number().over(within))
        rows = numbered.where(F.col("_n") <= k).drop("_n", "_part")
    final = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)


def search_ranked_batch(
    index: SearchIndex,
    documents: DataFrame,
    queries: DataFrame,
    top_k: int = TOP_K,
    all_terms: bool = False,
    live: LiveCheck | None = None,
    k: float = BM25_K,
    b: float = BM25_B,
    direct_pairs: int = DIRECT_PAIRS,
    pages: DataFrame | None = None,
) -> DataFrame:
    """Ranked search for a table (query_id, query): query_id, rank, file_name, page_number, score, document_id.

    With ``pages`` also the leading snippet of each page; it is cut where the page is read.

    Queries with the same terms are scored once, however many copies there are. The number of
    (query, page) pairs that plain scoring makes is known beforehand from the term statistics;
    above ``direct_pairs`` pages are scored block by block, with no row for a pair. Both are exact.
    """
    spark, stats = index.spark, index.settings
    scratch = shared_dir(spark, "ranked-batch")
    query_term_sets(index, queries).write.parquet(f"{scratch}/queries")
    asking = spark.read.parquet(f"{scratch}/queries").where(F.col("n_terms") > 0)
    # Written out, so the numbers stay what they are whatever is computed again.
    asking.select("terms_key", "n_terms").distinct().withColumn(
        "set_no", F.monotonically_increasing_id()
    ).write.parquet(f"{scratch}/sets")
    sets = spark.read.parquet(f"{scratch}/sets")

    n_pages, avg_len = F.lit(stats.n_pages), F.lit(float(stats.avg_len or 1.0))
    asked = sets.withColumn("term", F.explode(F.split("terms_key", " ")))
    asked = asked.withColumn("bucket", bucket_of(F.col("term"), stats.buckets))
    asked = (
        asked.join(index.only_buckets(index.terms, asked), ["bucket", "term"])
        .withColumn("idf", idf(F.col("df"), n_pages))
        .select("set_no", "n_terms", "bucket", "term", "df", "idf")
    )
    asked.write.parquet(f"{scratch}/terms")
    asked = spark.read.parquet(f"{scratch}/terms")

    weight = tf_weight(F.col("tf"), F.col("page_len"), avg_len, k, b)
    scoring = _Scoring(index, weight, live, index.only_buckets(index.lists, asked))
    pairs = asked.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    asked = asked.drop("df")
    if pairs <= direct_pairs:
        scored = scoring.page_scores(asked, all_terms)
    else:
        scored = scoring.best_scores(asked, top_k, all_terms, k, b)
    top = with_document_id(top_per_group(scored, ["set_no"], best_first(), top_k))
    numbered = asking.select("query_id", "terms_key").join(sets.select("terms_key", "set_no"), "terms_key")
    answered = numbered.join(top, "set_no")
    named = answered.join(documents.select("document_id", "file_name"), "document_id")
    columns = ["query_id", "rank", "file_name", "page_number", F.round("score", 3).alias("score"), "document_id"]
    if pages is not None:
        heads = pages.select("document_id", "page_number", text.snippet_head(F.col("page_text")).alias("snippet"))
        named = named.join(heads, ["document_id", "page_number"])
        columns.append("snippet")
    return named.select(*columns)


@dataclass(frozen=True)
class _Scoring:
    """Scores of pages for many term sets. Terms come as (set_no, n_terms, bucket, term, idf).

    ``lists`` are pruned to the folders of the asked terms beforehand.
    """

    index: SearchIndex
    weight: Column
    live: LiveCheck | None
    lists: DataFrame

    def lists_of(self, few: DataFrame) -> DataFrame:
        """Lists joined to rows that carry ``bucket`` and ``term``.

        Few rows are broadcast. More are joined by (term, part of the blocks), so that a term
        with very many pages or in very many queries is spread over ``SALTS`` tasks.
        """
        if few.count() <= BROADCAST_ROWS:
            return self.lists.join(F.broadcast(few), ["bucket", "term"])
        salt = F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        return self.lists.withColumn("_salt", salt).join(few.withColumn("_salt", every), ["bucket", "term", "_salt"]).drop("_salt")

    def page_scores(self, asked: DataFrame, all_terms: bool) -> DataFrame:
        """(set_no, doc_key, page_number, score), by one row per asked term and page holding it."""
        parts = self.index.living(self.lists_of(asked)).withColumn("part", F.col("idf") * self.weight)
        scored = parts.groupBy("set_no", *PAGE_KEY).agg(
            F.sum("part").alias("score"), F.count("*").alias("matched"), F.first("n_terms").alias("n_terms")
        )
        scored = _only_live(scored, self.live)
        if all_terms:
            scored = scored.where(F.col("matched") == F.col("n_terms"))
        return scored.drop("matched", "n_terms")

    def best_scores(self, asked: DataFrame, top_k: int, all_terms: bool, k: float, b: float) -> DataFrame:
        """The same for all pages that can be among the ``top_k`` of a set, block by block.

        A block has all postings of its pages, so a task multiplies the matrix of its pages' weights with
        that of the sets' terms and hands on the best pages of each set. Lists are shuffled packed,
        once for every ``SETS_AT_ONCE`` sets; postings or pairs never become rows.
        """
        n_parts = -(-asked.select("set_no").distinct().count() // SETS_AT_ONCE) or 1
        asked = asked.withColumn("_part", F.pmod(F.xxhash64("set_no"), F.lit(n_parts)).cast("int"))
        lists = self.lists_of(asked.select("bucket", "term").distinct())
        if self.index.n_dead or self.live is not None:
            lists = pack(_only_live(self.index.living(lists), self.live))
        lists = lists.select("block", "term", "doc_keys", "page_number", "tf", "page_len")
        if n_parts > 1:
            lists = lists.join(asked.select("_part", "term").distinct(), "term")
        else:
            lists = lists.withColumn("_part", F.lit(0))
        sets = asked.groupBy("_part", "set_no").agg(
            F.first("n_terms").alias("n_terms"), F.collect_list(F.struct("term", "idf")).alias("_terms")
        ).select(F.col("_part").alias("_of_part"), "set_no", "n_terms", F.col("_terms.term").alias("terms"), F.col("_terms.idf").alias("idfs"))
        # One number for some thousand pages, so this list stays short.
        sets = sets.crossJoin(F.broadcast(self.lists.select(F.col("block").alias("_block")).distinct()))
        avg_len = float(self.index.settings.avg_len or 1.0)

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            return _best_of_block(left, right, avg_len, k, b, top_k, all_terms)

        return lists.groupBy("_part", "block").cogroup(sets.groupBy("_of_part", "_block")).applyInArrow(
            score, "set_no long, doc_key binary, page_number int, score double"
        )


_BEST = pa.schema([("set_no", pa.int64()), ("doc_key", pa.binary()), ("page_number", pa.int32()), ("score", pa.float64())])


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy()


def _best_of_block(
    lists: pa.Table, sets: pa.Table, avg_len: float, k: float, b: float, top_k: int, all_terms: bool
) -> pa.Table:
    """(set_no, doc_key, page_number, score) of the pages of a block that can be among a set's ``top_k``.

    Of pages with just the same score those with the smallest keys are enough; others are kept if their score is
    within ``TIE_MARGIN`` of the last one.
    """
    asked = pc.list_flatten(sets.column("terms")).combine_chunks()
    terms = asked.unique()
    ask_sizes = pc.list_value_length(sets.column("terms")).to_numpy()
    n_sets, at_set = sets.num_rows, np.repeat(np.arange(sets.num_rows), ask_sizes)
    idfs = np.zeros((len(terms), n_sets))
    idfs[pc.index_in(asked, terms).to_numpy(), at_set] = _flat(sets.column("idfs"))
    n_terms = sets.column("n_terms").to_numpy()

    lists = lists.filter(pc.is_in(lists.column("term"), terms))
    if not lists.num_rows:
        return _BEST.empty_table()
    numbers, tf, length = (_flat(lists.column(c)) for c in ("page_number", "tf", "page_len"))
    sizes = pc.list_value_length(lists.column("page_number")).to_numpy()
    term = np.repeat(pc.index_in(lists.column("term").combine_chunks(), terms).to_numpy(), sizes)
    keys = _key_bytes(pc.list_flatten(lists.column("doc_keys")).combine_chunks()).view(">u8")
    order = np.lexsort((numbers, keys[:, 1], keys[:, 0]))
    keys, numbers, term, tf, length = keys[order], numbers[order], term[order], tf[order], length[order]
    weight = tf * (k + 1) / (tf + k * (1 - b + b * length / avg_len))
    new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1) | (numbers[1:] != numbers[:-1])) if len(keys) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    page = np.cumsum(new) - 1

    found = []
    for low in range(0, len(first), PAGES_AT_ONCE):
        high = min(low + PAGES_AT_ONCE, len(first))
        inside = slice(first[low], first[high] if high < len(first) else len(page))
        weights = np.zeros((high - low, len(terms)))
        weights[page[inside] - low, term[inside]] = weight[inside]
        scores = weights @ idfs
        fits = scores > 0  # an idf is above zero
        if all_terms:
            fits &= np.rint((weights > 0).astype(float) @ (idfs > 0)) == n_terms
            scores = np.where(fits, scores, 0)
        if len(scores) > top_k:
            fits &= scores >= np.partition(scores, -top_k, axis=0)[-top_k] - TIE_MARGIN
        at_page, of_set = np.nonzero(fits)
        found.append((of_set, at_page + low, scores[at_page, of_set]))
    of_set, at_page, score = map(np.concatenate, zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3
    order = np.lexsort((at_page, -score, of_set))
    of_set, at_page, score = of_set[order], at_page[order], score[order]
    place = np.arange(len(score))
    starts = lambda new: np.maximum.accumulate(np.where(np.append(True, new), place, 0)) if len(place) else place
    of_start = starts(of_set[1:] != of_set[:-1])
    run_start = starts((of_set[1:] != of_set[:-1]) | (score[1:] != score[:-1]))
    kth = np.minimum(of_start + top_k - 1, len(score) - 1)
    last = np.where(of_set[kth] == of_set, score[kth], 0.0) if len(score) else score
    kept = (place - run_start < top_k) & (score >= last - TIE_MARGIN)
    at = first[at_page[kept]] if len(score) else place
    set_nos = sets.column("set_no").to_numpy()[of_set[kept].astype(int)]
    return pa.table([set_nos, [x.tobytes() for x in keys[at]], numbers[at], score[kept].astype(float)], schema=_BEST)
