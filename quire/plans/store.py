"""Where documents, chunks and pages live.

Parquet has no DELETE, so every load is a new folder and nothing is changed in place:

``documents|document_pages|document_chunks/load_id=<id>/``
    the rows of one load. ``documents`` is written last; Spark's own ``_SUCCESS`` file in it is
    the commit mark. Rows of a load without it are invisible, and ``vacuum`` removes them.
``retired/load_id=<id>/``
    ids of documents that this load replaced or deleted: their rows of *earlier* loads are dead.

A reader names the committed folders. Only if documents have been retired does it also
anti-join their ids; a store that only grows is read without any join. One writer at a time.
"""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire import schemas
from quire.functions import identity, tokens
from quire.operators import grams, loading, ranking, search, segments
from quire.operators.chunks import MAX_CHUNK_BYTES
from quire.operators.ranking import LiveCheck, SearchIndex
from quire.operators.segments import Settings

DOCUMENTS, PAGES, CHUNKS, RETIRED = "documents", "document_pages", "document_chunks", "retired"
GRAMS = "grams"
# As stored: with the digest of each chunk and the root over those of a document, for ``verify_tree``.
TABLES = {
    DOCUMENTS: T.StructType([*schemas.DOCUMENTS.fields, T.StructField("content_root", T.StringType())]),
    PAGES: schemas.PAGES,
    CHUNKS: T.StructType([*schemas.CHUNKS.fields, T.StructField("chunk_sha256", T.StringType())]),
}
_RETIRED_SCHEMA = T.StructType([T.StructField("document_id", T.StringType())])
INDEX_MODES = ("in-place", "copy", "skip")
ROW_GROUP_BYTES = 64 * 1024 * 1024
_LOAD_ID = T.StructField("load_id", T.StringType())


class Folders:
    """The few file-system calls a store needs, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def matching(self, pattern: str) -> list[str]:
        return [status.getPath().toString() for status in self._fs.globStatus(self._path(pattern)) or []]

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@dataclass(frozen=True)
class Snapshot:
    """The committed loads at one moment, oldest first, and those among them that retired documents."""

    loads: tuple[str, ...]
    retiring: tuple[str, ...]


@dataclass
class PageStore:
    spark: SparkSession
    root: str
    _folders: Folders = field(init=False, repr=False)

    def __post_init__(self):
        if not self.root.startswith("/") and ":/" not in self.root:
            raise ValueError(f"a store needs an absolute path or URI that outlives the session, not {self.root!r}")
        self.root = self.root.rstrip("/")
        self._folders = Folders(self.spark, self.root)

    # --- snapshots and reads ------------------------------------------------------------

    def _ids(self, pattern: str) -> list[str]:
        return sorted(p.split("load_id=")[1].split("/")[0] for p in self._folders.matching(pattern))

    def snapshot(self) -> Snapshot:
        loads = self._ids(f"{self.root}/{DOCUMENTS}/load_id=*/_SUCCESS")
        retiring = set(self._ids(f"{self.root}/{RETIRED}/load_id=*/_SUCCESS"))
        return Snapshot(tuple(loads), tuple(x for x in loads if x in retiring))

    def _rows(self, table: str, schema: T.StructType, loads) -> DataFrame:
        with_load = T.StructType([*schema.fields, _LOAD_ID])
        written = set(self._ids(f"{self.root}/{table}/load_id=*")) if loads else set()
        folders = [f"{self.root}/{table}/load_id={x}" for x in loads if x in written]
        if not folders:
            return self.spark.createDataFrame([], with_load)
        return self.spark.read.option("basePath", f"{self.root}/{table}").schema(with_load).parquet(*folders)

    def retired(self, at: Snapshot | None = None) -> DataFrame:
        """(document_id, retired_by): earlier rows than ``retired_by`` of this document are dead."""
        at = at or self.snapshot()
        rows = self._rows(RETIRED, _RETIRED_SCHEMA, at.retiring)
        return rows.groupBy("document_id").agg(F.max("load_id").alias("retired_by"))

    def table(self, name: str, at: Snapshot | None = None, loads: tuple[str, ...] | None = None) -> DataFrame:
        """Live rows of a table, or of some of its ``loads``, with their ``load_id``."""
        at = at or self.snapshot()
        return self._living(self._rows(name, TABLES[name], at.loads if loads is None else loads), at)

    def _living(self, rows: DataFrame, at: Snapshot) -> DataFrame:
        """Stored rows but those of documents that a later load replaced or deleted."""
        if not at.retiring:
            return rows
        gone = self.retired(at).withColumnRenamed("document_id", "_gone")
        dead = (F.col("document_id") == F.col("_gone")) & (F.col("load_id") < F.col("retired_by"))
        return rows.join(gone, dead, "left_anti")

    def documents(self, at: Snapshot | None = None) -> DataFrame:
        return self.table(DOCUMENTS, at).select(*schemas.DOCUMENTS.fieldNames())

    def pages(self, at: Snapshot | None = None, loads: tuple[str, ...] | None = None) -> DataFrame:
        """Live pages. Rows stored before ``page_id`` existed get theirs on reading."""
        rows = self.table(PAGES, at, loads).select(*schemas.PAGES.fieldNames())
        made = identity.page_id(F.col("document_id"), F.col("page_number"))
        return rows.withColumn("page_id", F.coalesce("page_id", made))

    def chunks(self, at: Snapshot | None = None) -> DataFrame:
        return self.table(CHUNKS, at).select(*schemas.CHUNKS.fieldNames())

    # --- writes -------------------------------------------------------------------------

    def new_load_id(self) -> str:
        """Ids sort in the order of the loads."""
        used = self._ids(f"{self.root}/*/load_id=*")
        number = int(used[-1].split("-")[0]) + 1 if used else 1
        return f"{number:010d}-{uuid.uuid4().hex[:8]}"

    def write(self, table: str, rows: DataFrame, load_id: str, chunk_bytes: int = MAX_CHUNK_BYTES) -> DataFrame:
        """Write the rows of one load and return them as stored."""
        schema = TABLES.get(table, _RETIRED_SCHEMA)
        writer = rows.write.mode("errorifexists")
        if table == CHUNKS:
            # Readers hold a row group of chunks at a time, so its size is looked at after every few rows. A limit on
            # rows would make a group of every few small files, and writers hold what they know of all groups.
            rows_at_once = str(max(1, ROW_GROUP_BYTES // chunk_bytes))
            writer = writer.option("parquet.block.size", str(ROW_GROUP_BYTES))
            writer = writer.option("parquet.block.size.row.check.min", rows_at_once)
            writer = writer.option("parquet.block.size.row.check.max", rows_at_once)
        if table != RETIRED:
            # Look-ups by id skip files and row groups that cannot hold it.
            writer = writer.option("parquet.bloom.filter.enabled#document_id", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self.root}/{table}/load_id={load_id}")
        return self._rows(table, schema, [load_id]).drop("load_id")

    def discard(self, load_id: str) -> None:
        """Remove the rows of a load that failed or was never committed."""
        for table in (DOCUMENTS, PAGES, CHUNKS, RETIRED, GRAMS, "staging"):
            self._folders.remove(f"{self.root}/{table}/load_id={load_id}")

    def discard_staging(self, load_id: str) -> None:
        self._folders.remove(f"{self.root}/staging/load_id={load_id}")

    def ensure_tables(self) -> None:
        """Nothing needs to exist beforehand; an empty commit makes the store visible. Idempotent."""
        if not self.snapshot().loads:
            self.write(DOCUMENTS, self.spark.createDataFrame([], schemas.DOCUMENTS), self.new_load_id())

    def delete_documents(self, ids: DataFrame) -> int:
        """Delete documents given as (document_id); returns how many there were.

        The rows die with one small commit. The result is checked on the live tables.
        """
        load_id = self.new_load_id()
        doomed = self.documents().join(ids.select("document_id").distinct(), "document_id", "left_semi")
        gone = self.write(RETIRED, doomed.select("document_id").distinct(), load_id)
        self.write(DOCUMENTS, self.spark.createDataFrame([], schemas.DOCUMENTS), load_id)
        for name in (DOCUMENTS, PAGES, CHUNKS):
            left = self.table(name).join(gone, "document_id", "left_semi").limit(1).count()
            if left:
                raise RuntimeError(f"deleted documents still have rows in {name}")
        return gone.count()

    def delete_document(self, document_id: str) -> int:
        return self.delete_documents(self.spark.createDataFrame([(document_id,)], "document_id string"))

    def find_document(self, sha256_hex: str) -> DataFrame:
        return self.documents().where(F.col("sha256_hex") == sha256_hex).select("document_id")

    def vacuum(self) -> dict[str, int]:
        """Remove rows nobody can see: those of uncommitted loads, and dead rows of committed ones.

        Live rows that share a load with dead ones are copied to a new load, in whose commit
        the old load is retired; only then its folders go. Run it while nobody reads or writes.
        """
        at = self.snapshot()
        seen = set(self._ids(f"{self.root}/*/load_id=*"))
        abandoned = sorted(seen - set(at.loads))
        for load_id in abandoned:
            self.discard(load_id)
        affected: list[str] = []
        if at.retiring:
            gone = self.retired(at)
            rows = self._rows(DOCUMENTS, schemas.DOCUMENTS, at.loads).select("document_id", "load_id")
            dead = rows.join(gone, "document_id").where(F.col("load_id") < F.col("retired_by"))
            affected = sorted(r[0] for r in dead.select("load_id").distinct().collect())
        if affected:
            load_id = self.new_load_id()
            for name in (CHUNKS, PAGES, RETIRED, DOCUMENTS):
                source = DOCUMENTS if name == RETIRED else name
                kept = self.table(source, at).where(F.col("load_id").isin(affected))
                columns = ["document_id"] if name == RETIRED else TABLES[name].fieldNames()
                largest = 0
                if name == CHUNKS:
                    largest = kept.agg(F.max("chunk_length_bytes")).first()[0] or 0
                self.write(name, kept.select(*columns), load_id, max(1, largest))
            for old in affected:
                self.discard(old)
            # All dead rows are gone with their folders, so nothing is left to retire.
            for old in self._ids(f"{self.root}/{RETIRED}/load_id=*"):
                self._folders.remove(f"{self.root}/{RETIRED}/load_id={old}")
        return {"abandoned_loads": len(abandoned), "rewritten_loads": len(affected)}

    # --- index --------------------------------------------------------------------------

    def _index_root(self, location: str | None) -> str:
        return (location or f"{self.root}/index").rstrip("/")

    def build_index(
        self,
        location: str | None = None,
        mode: str | None = None,
        stemmer: str | None = "english",
        stop_words: str | list[str] | None = "english",
    ) -> int:
        """(Re)build the search index as one segment; returns the number of pages indexed, blank ones included.

        ``in-place``: over the stored pages; the default within the store. ``copy``: over a
        snapshot of the page text kept with the index; the default at another ``location``.
        ``skip``: nothing is built.
        """
        mode = mode or ("copy" if location else "in-place")
        if mode not in INDEX_MODES:
            raise ValueError(f"unknown index mode {mode!r}; known: {', '.join(INDEX_MODES)}")
        if mode == "skip":
            return 0
        words = tuple(tokens.stop_word_list(self.spark, stop_words))
        at = self.snapshot()
        n_pages = self.table(PAGES, at).count()
        settings = Settings(ranking.bucket_count(n_pages), ranking.check_stemmer(stemmer), words, mode == "copy")
        return self._grow(self._index_root(location), None, at, at.loads, n_pages, settings)

    def update_index(self, location: str | None = None, **settings: object) -> int:
        """Index the loads that are not indexed yet as a new segment; returns the number of their pages.

        Postings of earlier loads are not read, but for the merging of segments. What is missing is told
        from the index itself, so an update that is repeated adds nothing. The index is built
        anew if there is none, if ``vacuum`` has rewritten loads since, or if ``settings`` (as of
        ``build_index``) differ from those it was built with.
        """
        try:
            index = self.index(location)
        except LookupError:
            return self.build_index(location, **settings)
        at, first = self.snapshot(), index.segments[0]
        asked = dict(settings)
        same = ranking.check_stemmer(asked.get("stemmer", first.stemmer)) == first.stemmer
        same &= "stop_words" not in asked or tokens.stop_word_list(self.spark, asked["stop_words"]) == first.stop_words
        same &= asked.get("mode") in (None, "copy" if first.copied else "in-place")
        if not same or not set(index.loads) <= set(at.loads):
            kept = {"mode": "copy" if first.copied else "in-place", "stemmer": first.stemmer, "stop_words": first.stop_words}
            return self.build_index(location, **(kept | asked))
        fresh = tuple(x for x in at.loads if x not in index.loads)
        if not fresh:
            return 0
        shared = Settings(first.buckets, first.stemmer, tuple(first.stop_words), first.copied)
        return self._grow(self._index_root(location), index, at, fresh, self.table(PAGES, at, fresh).count(), shared)

    def _grow(
        self, base: str, index: SearchIndex | None, at: Snapshot, fresh: tuple[str, ...], n_pages: int, settings: Settings
    ) -> int:
        """A new version of an index: that of ``index``, if any, with a segment of the loads ``fresh``, merged where due."""
        number = self._next_version(base)
        last, name = (at.loads[-1] if at.loads else ""), f"{number:010d}-load"
        pages, rows = self.pages(at, fresh), {}
        if index is not None and not n_pages:  # deletions only
            name = index.segments[-1].segment
        else:
            n_tokens = segments.write_segment(copy_pages(pages) if settings.copied else pages, base, name, settings, n_pages)
            fixed = (settings.buckets, settings.stemmer, list(settings.stop_words), settings.copied)
            rows[name] = (name, n_pages, n_tokens, self.table(DOCUMENTS, at, fresh).count(), 0, last, *fixed)
        loads = dict.fromkeys(fresh, name)
        if index is not None:
            loads |= index.loads
            dead = self._dead(index, at)
            worn = {row.segment: row.n for row in dead.groupBy("segment").agg(F.count("*").alias("n")).collect()}
            for old in index.segments:
                rows[old.segment] = (*old[:4], worn.get(old.segment, 0), *old[5:])
        else:
            dead = self.spark.createDataFrame([], segments.DEAD)
        self._write_version(base, number, rows, loads, dead)
        due = segments.merges({s: r[1] for s, r in rows.items()}, {s for s, r in rows.items() if r[4] > segments.DEAD_SHARE * r[3]})
        if due:
            self._merge(base, number, at, due)
        self._forget_old(base, 3 if due else 2)
        return n_pages

    def _dead(self, index: SearchIndex, at: Snapshot) -> DataFrame:
        """(segment, doc_key): documents of a segment that were retired after it was written."""
        if not at.retiring:
            return self.spark.createDataFrame([], segments.DEAD)
        of = self.spark.createDataFrame(list(index.loads.items()), segments.LOADS)
        lasts = self.spark.createDataFrame([(s.segment, s.last_load) for s in index.segments], "segment string, last_load string")
        held = self._rows(DOCUMENTS, schemas.DOCUMENTS, list(index.loads)).select("document_id", "load_id")
        gone = held.join(self.retired(at), "document_id").join(of, "load_id").join(lasts, "segment")
        gone = gone.where((F.col("load_id") < F.col("retired_by")) & (F.col("last_load") < F.col("retired_by")))
        return gone.select("segment", identity.document_key(F.col("document_id")).alias("doc_key")).distinct()

    def _merge(self, base: str, number: int, at: Snapshot, due: list[list[str]]) -> None:
        """Version ``number`` with the segments of each group made one."""
        index = SearchIndex(self.spark, base, f"{base}/version={number:010d}")
        rows, loads = {s.segment: tuple(s) for s in index.segments}, dict(index.loads)
        for nth, members in enumerate(due):
            name = f"{number:010d}-merge{nth}"
            n_tokens = segments.merge_segments(index, members, name)
            inside = tuple(x for x in at.loads if loads[x] in members)
            n_pages = self.table(PAGES, at, inside).select("document_id").count()
            n_documents = self.table(DOCUMENTS, at, inside).select("document_id").count()
            fixed = rows[members[0]][6:]
            rows = {s: r for s, r in rows.items() if s not in members}
            rows[name] = (name, n_pages, n_tokens, n_documents, 0, at.loads[-1], *fixed)
            loads |= dict.fromkeys(inside, name)
        merged = [s for members in due for s in members]
        self._write_version(base, number + 1, rows, loads, index.dead.where(~F.col("segment").isin(merged)))

    def _write_version(self, base: str, number: int, rows: dict, loads: dict[str, str], dead: DataFrame) -> None:
        """The small tables of a version; ``segments`` comes last and makes it visible."""
        path, make = f"{base}/version={number:010d}", self.spark.createDataFrame
        dead.write.mode("overwrite").parquet(f"{path}/dead")
        make(sorted(loads.items()), segments.LOADS).coalesce(1).write.mode("overwrite").parquet(f"{path}/loads")
        make(list(rows.values()), segments.SEGMENT).coalesce(1).write.mode("overwrite").parquet(f"{path}/segments")

    def _forget_old(self, base: str, kept_versions: int) -> None:
        """Removes versions but the last ones, as readers may hold the one before, and segments that none of these has."""
        done = sorted(self._folders.matching(f"{base}/version=*/segments/_SUCCESS"))
        if len(done) <= kept_versions:
            return
        for old in done[:-kept_versions]:
            self._folders.remove(old.rsplit("/segments/", 1)[0])
        kept = {s.segment for path in done[-kept_versions:] for s in SearchIndex(self.spark, base, path.rsplit("/segments/", 1)[0]).segments}
        for folder in self._folders.matching(f"{base}/*/segment=*"):
            if folder.rsplit("segment=", 1)[1] not in kept:
                self._folders.remove(folder)

    def _next_version(self, base: str) -> int:
        used = [int(p.split("version=")[1]) for p in self._folders.matching(f"{base}/version=*")]
        return max(used, default=0) + 1

    def index(self, location: str | None = None) -> SearchIndex:
        """The newest complete version of the index."""
        base = self._index_root(location)
        done = sorted(self._folders.matching(f"{base}/version=*/segments/_SUCCESS"))
        if not done:
            raise LookupError("the store has no search index yet: call build_index()")
        return SearchIndex(self.spark, base, done[-1].rsplit("/segments/", 1)[0])

    def live_check(self, index: SearchIndex, at: Snapshot) -> LiveCheck | None:
        """What tells the index rows of pages that are gone; None if all its pages are alive.

        Loads only add pages, so only documents retired since the index was updated matter; it knows
        the earlier ones itself. If its loads have been rewritten since, all its pages are checked.
        """
        known = set(index.loads)
        pages = self.pages(at).select("document_id", "page_number")
        if not known <= set(at.loads):
            return LiveCheck(pages)
        since = [x for x in at.retiring if x not in known]
        if not since:
            return None
        changed = self._rows(RETIRED, _RETIRED_SCHEMA, since).select("document_id").distinct()
        return LiveCheck(pages.join(changed, "document_id", "left_semi"), changed)

    # --- searches -----------------------------------------------------------------------

    def document_text(self) -> DataFrame:
        at = self.snapshot()
        return search.document_text(self.documents(at), self.pages(at))

    def update_grams(self) -> int:
        """Index the trigrams of loads that lack it, so that ``search_pages`` reads candidate pages only; returns their number."""
        at, done = self.snapshot(), set(self._ids(f"{self.root}/{GRAMS}/load_id=*/_SUCCESS"))
        with_pages = set(self._ids(f"{self.root}/{PAGES}/load_id=*"))  # a load that only deletes has none
        fresh = [x for x in at.loads if x in with_pages and x not in done]
        for load_id in fresh:
            grams.write_grams(self._rows(PAGES, schemas.PAGES, [load_id]), f"{self.root}/{GRAMS}/load_id={load_id}")
        return len(fresh)

    def search_pages(self, term: str | None, limit: int | None = None) -> DataFrame:
        """Pages that contain the term in any case; ``%`` and ``_`` are wildcards.

        Loads whose trigrams are indexed (``update_grams``) are searched by these, all others by reading
        their pages; so are terms without a literal part of three characters.
        """
        at, documents = self.snapshot(), None
        done = set(self._ids(f"{self.root}/{GRAMS}/load_id=*/_SUCCESS")) & set(at.loads)
        wanted = grams.term_grams(self.spark, term) if done and term else []
        documents = self.documents(at)
        if not wanted:
            return search.search_pages(documents, self.pages(at), term, limit)
        inside, outside = ([x for x in at.loads if (x in done) == known] for known in (True, False))
        index = self.spark.read.option("basePath", f"{self.root}/{GRAMS}").schema(grams.GRAMS)
        index = index.parquet(*[f"{self.root}/{GRAMS}/load_id={x}" for x in inside])
        pages = grams.matching_pages(self._rows(PAGES, schemas.PAGES, inside), index, term, wanted)
        pages = self._living(pages, at)
        if outside:
            pages = pages.unionByName(self.table(PAGES, at, tuple(outside)))
        return search.search_pages(documents, pages, term, limit)

    def search_pages_ranked(
        self, query: str, top_k: int = ranking.TOP_K, all_terms: bool = False,
        location: str | None = None, **parameters: float,
    ) -> DataFrame:
        at, index = self.snapshot(), self.index(location)
        return ranking.search_ranked(
            index, self.documents(at), self.pages(at), query, top_k, all_terms,
            self.live_check(index, at), **parameters,
        )

    def search_pages_ranked_batch(
        self, queries: DataFrame, top_k: int = ranking.TOP_K, all_terms: bool = False,
        location: str | None = None, **parameters: float,
    ) -> DataFrame:
        at, index = self.snapshot(), self.index(location)
        return ranking.search_ranked_batch(
            index, self.documents(at), queries, top_k, all_terms,
            self.live_check(index, at), pages=self.pages(at), **parameters,
        )

    def register_sql(self, prefix: str = "") -> None:
        """Make the store usable from SQL in this session, as it is now.

        Views ``documents``, ``document_pages``, ``document_chunks`` and ``document_text``, and
        the table function ``search_pages(term)``, each with ``prefix`` before its name; and if the
        store has an index of its own, ``search_pages_ranked(query, top_k)`` and ``search_terms(text)``.
        A view keeps the snapshot it was made from; call again after a load.
        """
        at = self.snapshot()
        views = {"documents": self.documents(at), "document_pages": self.pages(at), "document_chunks": self.chunks(at),
                 "document_text": search.document_text(self.documents(at), self.pages(at))}
        for name, rows in views.items():
            rows.createOrReplaceTempView(f"{prefix}{name}")
        self.spark.sql(search.SEARCH_PAGES_SQL.format(prefix=prefix))
        with contextlib.suppress(LookupError):
            index = self.index()
            ranking.register_ranked_sql(index, self.live_check(index, at), prefix)

    def list_documents(self) -> DataFrame:
        return search.list_documents(self.documents())


def copy_pages(pages: DataFrame) -> DataFrame:
    """The snapshot that a copied index is built over."""
    return loading.migrate_page_id(pages).select("page_id", "document_id", "page_number", "page_text")
