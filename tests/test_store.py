"""Load, skip, replace, delete, fail, vacuum, stream: what stays visible."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import chunks, loading
from quire.operators.ocr import FileEngine
from quire.plans.load import LoadOptions, dry_run, load_files
from quire.plans.store import CHUNKS, DOCUMENTS, PAGES, PageStore
from quire.sources import files
from quire.sources.extract import TEXT, PageRange, Plugin
from quire.streaming.ingest import ingest, stream_files

OPTIONS = LoadOptions(chunk_bytes=1024)


def body(i):
    """A tide log of station ``i``: five pages of readings, each with a remark in its own case."""
    leaf = lambda n: f"Station {i}, leaf {n}. Low WATER mark " + " ".join(str(i * 1000 + n * 100 + k) for k in range(240))
    return "\f".join(map(leaf, range(5))).encode()


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "in"
    where.mkdir()
    for i in range(3):
        (where / f"f{i}.pdf").write_bytes(body(i))
    (where / "copy of f0.pdf").write_bytes(body(0))
    return where


@pytest.fixture
def store(spark, tmp_path):
    return PageStore(spark, str(tmp_path / "store"))


def scan(spark, folder):
    return files.scan_files(spark, source_dir=str(folder))


def sizes(store):
    return store.documents().count(), store.pages().count(), store.chunks().count()


def test_load_skip_replace(spark, store, folder):
    store.ensure_tables()
    store.ensure_tables()
    report = {r.file_name: r for r in load_files(store, scan(spark, folder), OPTIONS).collect()}
    assert len(report) == 4
    # The copy sorts first, so it is its content's winner.
    assert report["copy of f0.pdf"].status == "loaded" and report["f0.pdf"].status == "skipped"
    assert report["f0.pdf"].document_id == report["copy of f0.pdf"].document_id
    assert (report["f0.pdf"].page_count, report["f0.pdf"].chunk_count, report["f0.pdf"].total_text_chars) == (5, 0, 0)
    assert report["f1.pdf"].page_count == report["f1.pdf"].pages_with_text == 5
    assert report["f1.pdf"].chunk_count == -(-len(body(1)) // 1024)
    before = sizes(store)
    assert before[:2] == (3, 15)
    assert chunks.verify_chunks(store.chunks(), store.documents()).where("not intact").count() == 0
    first = store.documents().where("file_name = 'f1.pdf'").first()
    assert first.sha256_hex == hashlib.sha256(body(1)).hexdigest()
    assert (first.page_count, first.mime_type, first.file_extension) == (5, "application/pdf", "pdf")
    assert first.loaded_at is not None and first.chunk_size_bytes == 1024
    assert store.find_document(first.sha256_hex).first().document_id == first.document_id
    assert store.find_document("0" * 64).first() is None

    loads = store.snapshot().loads
    again = load_files(store, scan(spark, folder), OPTIONS).collect()
    assert {r.status for r in again} == {"skipped"} and sizes(store) == before
    assert store.snapshot().loads == loads

    replacing = LoadOptions(chunk_bytes=1024, replace=True)
    report = {r.file_name: r for r in load_files(store, scan(spark, folder), replacing).collect()}
    assert {r.status for r in report.values()} == {"loaded"}
    assert report["f0.pdf"].chunk_count == report["copy of f0.pdf"].chunk_count > 0
    assert sizes(store) == before
    assert {r.file_name for r in store.documents().collect()} == {"f0.pdf", "f1.pdf", "f2.pdf"}


def test_max_pages_and_text_view(spark, store, folder):
    load_files(store, scan(spark, folder), LoadOptions(chunk_bytes=1024, max_pages=2))
    row = store.documents().where("file_name = 'f2.pdf'").first()
    assert (row.page_count, row.pages_with_text) == (5, 2)
    whole = store.document_text().where("file_name = 'f2.pdf'").first()
    assert whole.document_text == "\f".join(body(2).decode().split("\f")[:2])
    assert store.search_pages("low water").count() == 6
    assert store.search_pages("LOW water", limit=4).count() == 4


def test_dry_run_writes_nothing(spark, store, folder):
    found = {r.file_name: r for r in dry_run(scan(spark, folder), OPTIONS).collect()}
    assert len(found) == 4 and found["f1.pdf"].total_text_chars == len(body(1)) - 4
    assert found["f1.pdf"].pages_with_text == 5
    assert store.snapshot().loads == ()


def test_delete_and_vacuum(spark, store, folder):
    load_files(store, scan(spark, folder), OPTIONS)
    victim = store.documents().where("file_name = 'f1.pdf'").first().document_id
    kept_chunks = store.chunks().where(F.col("document_id") != victim).count()
    assert store.delete_document(victim) == 1
    assert sizes(store) == (2, 10, kept_chunks)
    assert store.delete_document("no such id") == 0
    # Loading again brings it back.
    report = load_files(store, scan(spark, folder), OPTIONS)
    assert {r.file_name for r in report.where("status = 'loaded'").collect()} == {"f1.pdf"}
    before = sizes(store)
    store.write(PAGES, store.pages().limit(3), store.new_load_id())
    assert sizes(store) == before
    done = store.vacuum()
    assert done["abandoned_loads"] == 1 and done["rewritten_loads"] == 1
    assert sizes(store) == before and store.snapshot().retiring == ()
    assert chunks.verify_chunks(store.chunks(), store.documents()).where("not intact").count() == 0
    assert chunks.verify_tree(store.table(CHUNKS), store.table(DOCUMENTS)).where("intact").count() == 3
    assert store.vacuum() == {"abandoned_loads": 0, "rewritten_loads": 0}


def _breaks(stream, wanted: PageRange):
    if b"Station 2" in stream.read():
        raise ValueError("cannot read this one")
    yield {"page_number": 1, "page_text": "fine"}


def test_a_bad_file_costs_only_itself(spark, store, folder):
    options = LoadOptions(plugin=Plugin(_breaks))
    found = {r.file_name: r for r in dry_run(scan(spark, folder), options).collect()}
    assert "cannot read this one" in found["f2.pdf"].error and found["f1.pdf"].error is None
    report = {r.file_name: r for r in load_files(store, scan(spark, folder), options).collect()}
    assert report["f2.pdf"].status == "failed" and "cannot read this one" in report["f2.pdf"].error
    assert {r.status for name, r in report.items() if name != "f2.pdf"} == {"loaded", "skipped"}
    assert {r.file_name for r in store.documents().collect()} == {"copy of f0.pdf", "f1.pdf"}
    assert store.pages().count() == 2 and chunks.verify_chunks(store.chunks(), store.documents()).where("not intact").count() == 0
    assert not store._folders.matching(f"{store.root}/staging/load_id=*")


def test_unreadable_file_is_reported(spark, store, folder):
    def opener(uri):
        if uri.endswith("f1.pdf"):
            raise OSError("gone")
        return files.open_uri(uri)

    report = {r.file_name: r for r in load_files(store, scan(spark, folder), LoadOptions(opener=opener)).collect()}
    assert (report["f1.pdf"].status, report["f1.pdf"].error) == ("failed", "OSError: gone")
    assert {r.file_name for r in store.documents().collect()} == {"copy of f0.pdf", "f2.pdf"}


def test_broken_load_leaves_nothing(spark, store, folder, monkeypatch):
    monkeypatch.setattr(loading, "load_report", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load_files(store, scan(spark, folder), OPTIONS)
    assert store.snapshot().loads == () and sizes(store) == (0, 0, 0)
    assert not store._folders.matching(f"{store.root}/*/load_id=*")


def _slow(stream, wanted):
    """Takes its time over the third station's log."""
    for number, leaf in enumerate(stream.read().decode().split("\f"), start=1):
        if "Station 2" in leaf:
            time.sleep(0.2)
        yield {"page_number": number, "page_text": leaf}


@pytest.mark.parametrize("replace", [False, True])
def test_report_has_seconds_of_each_file(spark, store, folder, replace):
    options = LoadOptions(plugin=Plugin(_slow), replace=replace)
    report = {r.file_name: r for r in load_files(store, scan(spark, folder), options).collect()}
    seconds = {name: r.extract_seconds for name, r in report.items()}
    assert seconds["f2.pdf"] >= 1.0 > seconds["f1.pdf"] > 0
    # Of two copies one was extracted.
    assert sorted([seconds["f0.pdf"] is None, seconds["copy of f0.pdf"] is None]) == [False, True]
    assert sum(s for s in seconds.values() if s) <= 8 * report["f1.pdf"].load_seconds
    assert store.pages().count() == 15 and store.documents().count() == 3


def _no_pages(stream, wanted):
    return iter(())


def _read_image(payload):
    return f"Gauge reads {payload['page_number']} fathoms"


def _read_opened(file, number):
    return f"opened {number}" if not file.closed else ""


def _scanned(stream, wanted):
    for number in (1, 2):
        yield {"page_number": number, "page_text": "", "image_count": number - 1}


def _hides(stream, name):
    return {"page_count": 1, "layer_names": ["A", "B"], "hidden_layer_names": ["B"] if name == "f1.pdf" else []}


def test_documents_without_pages_stay(spark, store, folder):
    load_files(store, scan(spark, folder), LoadOptions(plugin=Plugin(_no_pages, TEXT.inspect)))
    rows = store.documents().collect()
    assert len(rows) == 3 and {(r.pages_with_text, r.pages_ocr, r.total_text_chars) for r in rows} == {(0, 0, 0)}
    assert store.document_text().count() == 0


def test_recognition_in_a_load(spark, store, folder):
    report = load_files(store, scan(spark, folder), LoadOptions(plugin=Plugin(_scanned)))
    assert {r.pages_needing_ocr for r in report.where("status = 'loaded'").collect()} == {1}
    options = LoadOptions(plugin=Plugin(_scanned), ocr_engine=_read_image, replace=True)
    load_files(store, scan(spark, folder), options)
    assert {(r.pages_with_text, r.pages_ocr, r.page_count) for r in store.documents().collect()} == {(1, 1, 2)}
    assert store.search_pages("FATHOMS").count() == 3
    by_file = LoadOptions(plugin=Plugin(_scanned), ocr_files=FileEngine(files.open_uri, _read_opened), replace=True)
    load_files(store, scan(spark, folder), by_file)
    assert store.search_pages("opened 2").count() == 3 and store.search_pages("FATHOMS").count() == 0


def test_reveal_is_reported(spark, store, folder):
    options = LoadOptions(plugin=Plugin(_scanned, _hides), reveal_hidden_layers=True)
    load_files(store, scan(spark, folder), options)
    found = {r.file_name: r.hidden_layers_revealed for r in store.documents().collect()}
    assert found["f1.pdf"] is True and found["f2.pdf"] is False


def test_store_needs_a_lasting_place(spark):
    for place in ("", "memory", "temp", "relative/path"):
        with pytest.raises(ValueError):
            PageStore(spark, place)


def test_stream_equals_batch(spark, store, folder, tmp_path):
    batch = PageStore(spark, str(tmp_path / "batch"))
    stream = lambda: ingest(store, stream_files(spark, str(folder)), str(tmp_path / "cp"), OPTIONS)
    stream().awaitTermination()
    (folder / "late.PDF").write_bytes(body(9))
    (folder / "late copy.pdf").write_bytes(body(1))
    stream().awaitTermination()
    load_files(batch, scan(spark, folder), OPTIONS)
    keys = lambda s, t, *c: sorted(map(tuple, s.table(t).select("document_id", *c).collect()))
    for table, columns in ((PAGES, ("page_number", "page_text")), (CHUNKS, ("chunk_index", "content")),
                           (DOCUMENTS, ("sha256_hex", "page_count", "chunk_count", "total_text_chars"))):
        assert keys(store, table, *columns) == keys(batch, table, *columns)
    assert len(store.snapshot().loads) == 2


def test_hot_key_join_is_whole(spark):
    rows = spark.range(100).selectExpr("id", "case when id < 60 then 'hot' else cast(id as string) end as k")
    rows = rows.union(spark.sql("select 100L, cast(null as string)"))
    lookup = spark.range(50, 100).selectExpr("cast(id as string) as k", "id * 2 as v").union(spark.sql("select 'hot', -1L"))
    found = {r.id: r.v for r in loading.join_unique(rows, lookup, "k").collect()}
    assert len(found) == 101 and found[3] == -1 and found[75] == 150 and found[100] is None


def test_winners(spark):
    rows = spark.createDataFrame([(i, f"h{i % 3}", f"p{i}") for i in range(9)], "ordinal long, sha256_hex string, file_path string")
    assert sorted(r.ordinal for r in loading.choose_winners(rows).collect()) == [0, 1, 2]
    last = {r.sha256_hex: r.file_path for r in loading.choose_winners(rows, replace=True).collect()}
    assert last == {"h0": "p6", "h1": "p7", "h2": "p8"}


@pytest.mark.parametrize("skipped", [0, 2, 15])
def test_content_is_not_shuffled(spark, tmp_path, skipped):
    rows = [(i, f"/f{i}", f"f{i}", 2, f"c{i}".encode()) for i in range(20)]
    table = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    table.write.parquet(str(tmp_path / "files"))
    table = spark.read.parquet(str(tmp_path / "files"))
    chosen = table.drop("content").where(F.col("ordinal") >= skipped)
    found = loading.chosen_content(table, table.drop("content"), chosen)
    assert sorted(bytes(r.content) for r in found.collect()) == sorted(f"c{i}".encode() for i in range(skipped, 20))
    expected = files.with_identity(files.with_hash(table)).where(F.col("ordinal") >= skipped)
    assert {r.document_id for r in found.collect()} == {r.document_id for r in expected.collect()}
    shuffles = [x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert all("content" not in x for x in shuffles) and len(shuffles) <= 2


def test_index_is_built_only_if_something_loaded(spark, store, folder):
    from quire.plans.load import load_and_index

    load_and_index(store, scan(spark, folder), OPTIONS, stemmer=None, stop_words=None)
    assert store.update_index(mode="in-place") == 0
    first = store.index().path
    load_and_index(store, scan(spark, folder), OPTIONS, stemmer=None, stop_words=None)
    assert store.index().path == first
    assert store.build_index(mode="skip") == 0 and store.index().path == first
    with pytest.raises(ValueError, match="unknown index mode"):
        store.build_index(mode="elsewhere")
    # The version before the newest stays for its readers, older ones go.
    for _ in range(2):
        store.build_index(stemmer=None, stop_words=None)
    versions = store._folders.matching(f"{store.root}/index/version=*")
    assert len(versions) == 2 and first not in store.index().path


def test_sql_surface(spark, store, folder):
    load_files(store, scan(spark, folder), OPTIONS)
    store.register_sql("t_")
    assert spark.sql("SELECT * FROM t_document_text").count() == 3
    found = spark.sql("SELECT * FROM t_search_pages('water MARK')")
    plain = store.search_pages("water MARK")
    assert found.columns == plain.columns and sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert spark.sql(r"SELECT * FROM t_search_pages('back\\slash')").count() == 0


def files_read(frame) -> int:
    """Page files that the scan of a query opened."""
    frame.collect()
    leaves, found = [frame._jdf.queryExecution().executedPlan()], 0
    while leaves:
        node = leaves.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            leaves.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            leaves.append(node.plan())
        else:
            if name == "FileSourceScanExec" and "page_text" in node.toString():
                found += node.metrics().apply("numFiles").value()
            leaves += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_substring_search_by_trigrams(spark, store, folder):
    """The same rows with and without the index, for loads with and without it; only files with candidates are opened."""
    load_files(store, scan(spark, folder), OPTIONS)
    (folder / "odd.pdf").write_text("Straße 99%_x\\y ÄRGER \U0001f600\U0001f601\U0001f602 finis\fplain page\fİstanbul", encoding="utf-8")
    (folder / "late.pdf").write_bytes(body(7))
    load_files(store, scan(spark, folder), OPTIONS)
    terms = ["low WATER", "Station 2, leaf 3", "st_tion%leaf 1", "finis", "ärger", "99%", "\\y", "\U0001f600\U0001f601\U0001f602", "istanbul", "i\u0307stan",
             "ab", "%", "", "no such words", "7403 7404", "s" * 90]
    rows = lambda term: [tuple(r) for r in store.search_pages(term).collect()]
    plain = {term: rows(term) for term in terms}
    assert len(plain["low WATER"]) == 20 and len(plain["finis"]) == 1 and len(plain["Station 2, leaf 3"]) == 1
    every = files_read(store.search_pages("finis"))
    assert store.update_grams() == 2 and store.update_grams() == 0
    assert {term: rows(term) for term in terms} == plain
    assert files_read(store.search_pages("finis")) == 1 < every
    assert files_read(store.search_pages("no such words")) == 0 and files_read(store.search_pages("ti")) == every
    assert store.search_pages(None).count() == 0 and store.search_pages("low water", limit=4).count() == 4
    # A load without trigrams is read as a whole; deleted and replaced documents are gone.
    (folder / "new.pdf").write_bytes(body(8))
    load_files(store, scan(spark, folder), OPTIONS)
    store.delete_document(store.documents().where("file_name = 'odd.pdf'").first().document_id)
    load_files(store, scan(spark, folder).where("file_name = 'f1.pdf'"), LoadOptions(chunk_bytes=1024, replace=True, max_pages=2))
    assert rows("finis") == [] and len(rows("low water")) == 22 and len(rows("Station 1, leaf 1")) == 1
    store.vacuum()
    assert len(rows("low water")) == 22
    assert store.update_grams() >= 1 and len(rows("low water")) == 22 and rows("finis") == []
