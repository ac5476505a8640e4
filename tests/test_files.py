"""File listing, extraction, recognition and chunks on small generated files."""

import hashlib
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire.operators import chunks, ocr
from quire.operators.checks import conform, not_null_violations
from quire.schemas import CHUNKS
from quire.sources import files
from quire.sources.extract import HTML, PAGES_PER_UNIT, TEXT, PageRange, Plugin, extract_pages, pages_of_text

#: Bytes without a pattern; no multiple of any chunk size used here.
BLOB = hashlib.shake_128(b"quire").digest(9_973)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    for name, body in {
        "b.pdf": b"%PDF-b", "A.PDF": b"%PDF-a", "c.txt": b"one\ftwo", "sub/d.pdf": b"deep", "blob.bin": BLOB, "empty.bin": b"",
    }.items():
        (tmp_path / name).write_bytes(body)
    return tmp_path


def names(frame):
    return [row.file_name for row in frame.orderBy("ordinal").collect()]


def test_scan_order(spark, folder):
    assert names(files.scan_files(spark, source_dir=str(folder))) == ["A.PDF", "b.pdf"]
    explicit = [str(folder / "c.txt"), str(folder / "b.pdf"), str(folder / "c.txt")]
    assert names(files.scan_files(spark, explicit)) == ["c.txt", "b.pdf", "c.txt"]
    assert names(files.scan_files(spark, explicit[:1], str(folder))) == ["c.txt", "A.PDF", "b.pdf"]
    with pytest.raises(ValueError, match="no files"):
        files.scan_files(spark)


def test_paths_are_literal(spark, tmp_path):
    odd = ["report[1].pdf", "a{b}.pdf", "star*.pdf", "two words.pdf", "what?.pdf"]
    for name in [*odd, "report1.pdf", "starry.pdf"]:
        (tmp_path / name).write_bytes(name.encode())
    listed = files.scan_files(spark, [str(tmp_path / name) for name in odd])
    assert names(listed) == odd
    assert {r.file_name: r.sha256_hex for r in files.with_hash(listed).collect()} == {
        name: hashlib.sha256(name.encode()).hexdigest() for name in odd
    }
    with pytest.raises(Exception, match="(?i)no such file|not exist|not_found"):
        files.scan_files(spark, [str(tmp_path / "report1.pdf"), str(tmp_path / "report[2].pdf")])


def test_hashing_is_spread(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"f{i:02d}.pdf").write_bytes(b"%d" % i)
    listed = files.scan_files(spark, source_dir=str(tmp_path))
    assert files.with_hash(listed).select(F.spark_partition_id()).distinct().count() > 1
    first, second = ({r.file_name: r.ordinal for r in listed.select("ordinal", *c).collect()} for c in (["file_name"], ["file_path", "file_name"]))
    assert first == second and len(set(first.values())) == 60


def test_hash_and_identity(spark, folder):
    listed = files.scan_files(spark, [str(folder / "blob.bin"), str(folder / "b.pdf"), str(folder / "empty.bin")])
    by_path = {r.file_name: r for r in files.with_identity(files.with_hash(listed)).collect()}
    assert by_path["blob.bin"].sha256_hex == hashlib.sha256(BLOB).hexdigest()
    assert by_path["empty.bin"].sha256_hex == hashlib.sha256(b"").hexdigest()
    assert by_path["b.pdf"].mime_type == "application/pdf" and by_path["b.pdf"].file_extension == "pdf"
    assert by_path["blob.bin"].file_size_bytes == len(BLOB)
    in_table = listed.withColumn("content", F.lit(BLOB))
    assert {r.sha256_hex for r in files.with_hash(in_table).collect()} == {hashlib.sha256(BLOB).hexdigest()}


#: What an inspector says of two made-up charts: dates with offsets, blank fields, layers off and on.
CHARTS = {
    "A.PDF": {"page_count": 17, "title": "  Harbour chart ", "author": "", "creator": "plotter 9",
              "created_raw": "D:19990704031500+05'30'", "modified_raw": "not a date",
              "layer_names": ["soundings", "wrecks", "buoys"], "hidden_layer_names": ["wrecks", "buoys"]},
    "b.pdf": {"page_count": 2, "author": "N. Sextant", "modified_raw": "D:2011", "encryption_method": "RC4",
              "needs_password": True, "layer_names": ["coast"]},
}


def _info(stream, name):
    return CHARTS[name]


def test_inspection_is_normalised(spark, folder):
    listed = files.with_identity(files.with_hash(files.scan_files(spark, source_dir=str(folder))))
    found = files.inspect_files(listed, _info)
    dates = {f"{c}_us": F.unix_micros(f"pdf_{c}_at") for c in ("created", "modified")}
    rows = {r.file_name: r for r in found.withColumns(dates).collect()}
    chart, locked = rows["A.PDF"], rows["b.pdf"]
    assert chart.page_count == 17 and chart.author is None and chart.title.strip() == "Harbour chart"
    assert chart.created_us == 931_038_300_000_000 and chart.modified_us is None  # 21:45 UTC, the evening before
    assert (chart.is_encrypted, chart.needs_password, chart.encryption_method) == (False, False, None)
    assert (locked.is_encrypted, locked.needs_password, locked.encryption_method) == (True, True, "RC4")
    assert locked.title is None and locked.created_us is None and locked.modified_us == 1_293_840_000_000_000
    hidden = sorted((r.file_name, r.layer_name) for r in files.hidden_layer_documents(found).collect())
    assert hidden == [("A.PDF", "buoys"), ("A.PDF", "wrecks")]


def test_text_plugin_and_cap(spark, folder):
    listed = files.scan_files(spark, [str(folder / "c.txt")]).withColumn("document_id", F.lit("d"))
    rows = sorted((r.page_number, r.page_text, r.page_id) for r in extract_pages(listed, TEXT).collect())
    assert rows == [(1, "one", "d:1"), (2, "two", "d:2")]
    assert extract_pages(listed, TEXT, max_pages=1).count() == 1
    same = listed.withColumn("content", F.lit(b"one\ftwo"))
    assert sorted((r.page_number, r.page_text, r.page_id) for r in pages_of_text(same).collect()) == rows
    assert [r.page_text for r in pages_of_text(same, 4, 1).collect()] == ["one\f"]


def test_html_plugin(spark):
    html = "<html><head><title>T &amp; t</title><meta name=author content=me><script>x()</script></head><p>a  b<p>c<img></html>"
    rows = spark.createDataFrame([("d", 0, "x.html", html.encode())], "document_id string, ordinal long, file_name string, content binary")
    page = extract_pages(rows, HTML).first()
    assert (page.page_text, page.image_count, page.extraction_method) == ("a b\nc", 1, "native")
    info = files.inspect_files(rows, HTML.inspect).first()
    assert (info.title, info.author, info.page_count) == ("T & t", "me", 1)


def _numbered(stream, wanted: PageRange):
    total = int(stream.read())
    for number in range(wanted.first, min(total, wanted.last or total) + 1):
        shown = f"text {number}" if number % 2 else " \u00a0"
        yield {"page_number": number, "page_label": "" if number == 1 else str(number), "page_text": shown,
               "width_pt": 595.0, "height_pt": 842.0, "image_count": number % 4, "rotation": 0}


def test_long_file_is_split_into_units(spark, tmp_path):
    total = PAGES_PER_UNIT * 2 + 5
    (tmp_path / "long.pdf").write_text(str(total))
    listed = files.scan_files(spark, source_dir=str(tmp_path)).withColumns(
        {"document_id": F.lit("d"), "page_count": F.lit(total)}
    )
    pages = extract_pages(listed, Plugin(_numbered, random_access=True))
    rows = {r.page_number: r for r in pages.collect()}
    assert sorted(rows) == list(range(1, total + 1))
    assert rows[1].page_label is None and rows[3].page_label == "3"
    assert rows[3].extraction_method == "native" and rows[3].char_count == len("text 3")
    assert rows[2].extraction_method == "none" and rows[2].page_text == " \u00a0"
    assert extract_pages(listed, Plugin(_numbered, random_access=True), max_pages=7).count() == 7


def _engine(payload):
    if payload["page_number"] == 6:
        raise OSError("unreadable")
    return "" if payload["page_number"] == 10 else f"seen {payload['page_number']}"


def test_recognition(spark, tmp_path):
    (tmp_path / "scan.pdf").write_text("12")
    listed = files.scan_files(spark, source_dir=str(tmp_path)).withColumn("document_id", F.lit("d"))
    pages = extract_pages(listed, Plugin(_numbered))
    wanted = ocr.ocr_candidates(pages)
    assert sorted(r.page_number for r in wanted.collect()) == [2, 6, 10]
    found = ocr.run_ocr(wanted, _engine, ["page_number"], partitions=2)
    errors = {r.page_number: r.error for r in found.collect()}
    assert errors[2] is None and "unreadable" in errors[6]
    merged = {r.page_number: r for r in ocr.merge_ocr(pages, found).collect()}
    assert len(merged) == 12
    assert (merged[2].extraction_method, merged[2].page_text, merged[2].char_count) == ("ocr", "seen 2", 6)
    assert merged[6].extraction_method == "none" and merged[10].page_text == " \u00a0"
    assert merged[4].extraction_method == "none" and merged[3].extraction_method == "native"


class _Scan:
    """An opened scan: notes when it is opened and closed in a folder beside it."""

    def __init__(self, path):
        if path.endswith("bad.scan"):
            raise OSError("cannot be opened")
        self.log = Path(path).parent / "opens" / f"{Path(path).name}-{uuid.uuid4().hex}"
        self.log.write_text("open")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.log.write_text("closed")


def _read_page(scan, number):
    if number % 50 == 7:
        raise ValueError("smudged")
    return f"{scan.log.name.split('-')[0]} {number}"


def test_recognition_opens_files_for_runs_of_pages(spark, tmp_path):
    (tmp_path / "opens").mkdir()
    sizes = {"long.scan": 400, "bad.scan": 5, **{f"s{i}.scan": 1 + i % 3 for i in range(20)}}
    rows = [(name, number, str(tmp_path / name)) for name, n in sizes.items() for number in range(1, n + 1)]
    pages = spark.createDataFrame(rows, "document_id string, page_number int, file_path string").repartition(6)
    tasks = 4
    units = ocr._units(pages, F.lit(1), tasks).groupBy("task").count().collect()
    assert len(units) == tasks and max(r["count"] for r in units) < 1.4 * len(rows) / tasks
    found = {(r.document_id, r.page_number): r for r in ocr.run_ocr_files(pages, ocr.FileEngine(_Scan, _read_page), tasks=tasks).collect()}
    assert len(found) == len(rows)
    for (name, number), row in found.items():
        smudged, bad = number % 50 == 7, name == "bad.scan"
        assert (row.ocr_text == "") == (smudged or bad) and (row.error is None) == (row.ocr_text != "")
        assert row.ocr_text in ("", f"{name} {number}") and (not bad or "cannot be opened" in row.error)
    opens = Counter(p.name.split("-")[0] for p in (tmp_path / "opens").iterdir())
    assert all(opens[f"s{i}.scan"] == 1 for i in range(20)) and 2 <= opens["long.scan"] <= tasks
    assert {p.read_text() for p in (tmp_path / "opens").iterdir()} == {"closed"}
    assert ocr.run_ocr_files(pages.limit(0), ocr.FileEngine(_Scan, _read_page), tasks=tasks).count() == 0


def test_chunks_of_column_and_of_path(spark, folder):
    listed = files.scan_files(spark, [str(folder / "blob.bin"), str(folder / "empty.bin")])
    listed = listed.withColumn("document_id", F.col("file_name"))
    by_path = files.read_chunks(listed, 4096).orderBy("chunk_index").collect()
    column = spark.createDataFrame([("blob.bin", BLOB), ("empty.bin", b"")], "document_id string, content binary")
    by_column = chunks.cut_chunks(column, 4096).orderBy("chunk_index").collect()
    assert by_path == by_column
    assert [r.byte_offset for r in by_path] == [0, 4096, 8192]
    assert [r.chunk_length_bytes for r in by_path] == [4096, 4096, 9_973 - 8192]
    assert b"".join(bytes(r.content) for r in by_path) == BLOB
    with pytest.raises(ValueError):
        chunks.cut_chunks(column, 0)


def _documents(spark):
    rows = [
        ("d", hashlib.sha256(BLOB).hexdigest(), len(BLOB), 1000, 10),
        ("empty", hashlib.sha256(b"").hexdigest(), 0, 1000, 0),
    ]
    return spark.createDataFrame(
        rows, "document_id string, sha256_hex string, file_size_bytes long, chunk_size_bytes int, chunk_count int"
    )


def test_verification_finds_damage(spark):
    documents = _documents(spark)
    column = spark.createDataFrame([("d", BLOB)], "document_id string, content binary")
    good = chunks.cut_chunks(column, 1000)
    swapped = good.withColumn("content", F.when(F.col("chunk_index") == 3, F.lit(b"x" * 1000)).otherwise(F.col("content")))
    lost = good.where("chunk_index <> 4")
    doubled = good.union(good.where("chunk_index = 5"))
    intact = lambda c: {r.document_id: r.intact for r in chunks.verify_chunks(c, documents).collect()}
    complete = lambda c: {r.document_id: r.complete for r in chunks.chunk_gaps(c, documents).collect()}
    assert intact(good) == complete(good) == {"d": True, "empty": True}
    assert intact(swapped) == {"d": False, "empty": True} and complete(swapped)["d"]
    for broken in (lost, doubled):
        assert not intact(broken)["d"] and not complete(broken)["d"]
    assert chunks.chunk_order(lost).where("not continues").count() == 1
    assert chunks.chunk_order(good).where("not continues").count() == 0


def test_tree_names_damaged_chunks(spark, tmp_path, monkeypatch):
    """Damage is found where the chunk is read, and nothing of the bytes is shuffled."""
    monkeypatch.setattr(chunks, "TREE_FANOUT", 4)
    spark.createDataFrame([("d", BLOB), ("empty", b"")], "document_id string, content binary").write.parquet(str(tmp_path / "files"))
    column = spark.read.parquet(str(tmp_path / "files"))
    good = chunks.with_digest(chunks.cut_chunks(column, 1000))
    digests = [hashlib.sha256(BLOB[i : i + 1000]).hexdigest() for i in range(0, len(BLOB), 1000)]
    nodes = [hashlib.sha256("".join(digests[i : i + 4]).encode()).hexdigest() for i in range(0, 10, 4)]
    root = hashlib.sha256("".join(nodes).encode()).hexdigest()
    assert [r.content_root for r in chunks.tree_roots(good).collect()] == [root]
    documents = _documents(spark).withColumn("content_root", F.when(F.col("document_id") == "d", root))
    verified = lambda c: {r.document_id: (r.damaged_chunks, r.intact) for r in chunks.verify_tree(c, documents).collect()}
    assert verified(good) == {"d": ([], True), "empty": ([], True)}
    hurt = good.withColumn("content", F.when(F.col("chunk_index").isin(3, 8), F.lit(b"x" * 1000)).otherwise(F.col("content")))
    assert verified(hurt) == {"d": ([3, 8], False), "empty": ([], True)}
    for broken in (good.where("chunk_index <> 4"), good.union(good.where("chunk_index = 5")), good.withColumn("chunk_sha256", F.lit("0"))):
        assert not verified(broken)["d"][1]
    for line in chunks.verify_tree(good, documents)._jdf.queryExecution().executedPlan().toString().split("\n"):
        assert "Exchange" not in line or "content#" not in line
    plan = chunks.verify_tree(good, documents)._jdf.queryExecution().optimizedPlan().toString()
    assert all("content#" not in x.split("Aggregate", 1)[1] or "sha2" in x for x in plan.split("\n") if "Aggregate" in x)


def test_required_columns(spark):
    rows = spark.createDataFrame([("d", 0, None, 1, b"x")], "document_id string, chunk_index int, byte_offset long, chunk_length_bytes int, content binary")
    counted = {r.column_name: r.null_rows for r in not_null_violations(rows, ["document_id", "byte_offset"]).collect()}
    assert counted == {"document_id": 0, "byte_offset": 1}
    with pytest.raises(Exception, match="byte_offset is NULL"):
        conform(rows, CHUNKS).collect()
