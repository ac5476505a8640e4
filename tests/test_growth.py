"""What has to stay in bounds as the input grows: batches, row groups, posting lists, block scoring."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quire.operators import ranking
from quire.plans import queries
from quire.plans.load import LoadOptions, load_files
from quire.plans.store import PageStore
from quire.sources import extract


def test_pages_leave_in_small_batches():
    """A row of seconds follows every page, so the number of rows may pass the limit without meeting it at a page."""
    rows = [row for n in range(1000) for row in ({"page_number": 1, "page_text": "x"}, {"seconds": 0.1})]
    found = list(extract.row_batches(iter(rows)))
    assert [row for held in found for row in held] == rows
    assert max(map(len, found)) <= extract.PAGES_PER_BATCH
    long = [{"page_text": "x" * extract.CHARS_PER_BATCH}] * 3
    assert [len(held) for held in extract.row_batches(iter(long))] == [1, 1, 1]


def file_rows(spark, texts):
    rows = [(i, f"/f{i}.txt", f"f{i}.txt", len(t), t.encode()) for i, t in enumerate(texts)]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    return files.withColumn("file_modified_at", F.current_timestamp())


def test_small_files_share_row_groups(spark, tmp_path):
    """Chunks of up to 8 MiB: a row group is full by its bytes, not with every eighth small file."""
    store = PageStore(spark, str(tmp_path / "store"))
    load_files(store, file_rows(spark, [f"text {i}" for i in range(400)]).coalesce(1), LoadOptions(page_chars=0))
    parts = [pq.ParquetFile(p).metadata for p in (tmp_path / "store").glob("document_chunks/*/*.parquet")]
    assert sum(p.num_rows for p in parts) == 400
    assert all(p.num_row_groups == 1 for p in parts if p.num_rows)


def test_postings_are_stored_in_lists(spark, tmp_path):
    store = PageStore(spark, str(tmp_path / "store"))
    load_files(store, file_rows(spark, [f"common twice twice file{chr(97 + i)}" for i in range(20)]), LoadOptions(page_chars=0))
    store.build_index(stemmer=None, stop_words=None)
    lists = store.index().lists
    assert lists.where("term = 'common'").count() <= lists.select("block").distinct().count()
    rows = store.index().postings.where("term = 'twice'").collect()
    assert len(rows) == 20 and {(r.tf, r.page_len, r.page_number) for r in rows} == {(2, 4, 1)}
    assert {bytes(r.doc_key).hex() for r in rows} == {r.document_id.replace("-", "") for r in store.documents().collect()}
    again = ranking.unpack(ranking.pack(store.index().postings))
    key = lambda r: (r.block, r.term, bytes(r.doc_key), r.page_number, r.tf, r.page_len)
    columns = ["block", "term", "doc_key", "page_number", "tf", "page_len"]
    assert sorted(map(key, again.select(columns).collect())) == sorted(map(key, store.index().postings.select(columns).collect()))


@pytest.mark.parametrize("all_terms", [False, True])
def test_best_of_block(all_terms):
    """Blocks of several pieces against plain sums; of equal pages the smallest keys stay."""
    rng = np.random.default_rng(5)
    n_pages, n_terms, top_k = 3 * ranking.PAGES_AT_ONCE // 2, 6, 4
    tf = rng.integers(0, 3, (n_pages, n_terms))
    tf[100:200] = tf[100]
    keys = [int(i).to_bytes(16, "big") for i in rng.permutation(n_pages)]
    rows = [(f"t{t}", np.flatnonzero(tf[:, t])) for t in range(n_terms)]
    lists = pa.table({
        "term": [term for term, _ in rows], "doc_keys": pa.array([[keys[i] for i in at] for _, at in rows], pa.list_(pa.binary())),
        "page_number": pa.array([[1] * len(at) for _, at in rows], pa.list_(pa.int32())),
        "tf": pa.array([tf[at, t].tolist() for t, (_, at) in enumerate(rows)], pa.list_(pa.int32())),
        "page_len": pa.array([[9] * len(at) for _, at in rows], pa.list_(pa.int32())),
    })
    asked = {3: {"t0": 1.0, "t4": 0.5}, 8: {"t1": 0.2, "t2": 0.3, "t5": 2.0}}
    sets = pa.table({
        "set_no": pa.array(list(asked), pa.int64()), "n_terms": pa.array([len(x) for x in asked.values()], pa.int32()),
        "terms": [list(x) for x in asked.values()], "idfs": [list(x.values()) for x in asked.values()],
    })
    found = ranking._best_of_block(lists, sets, 9.0, 1.2, 0.75, top_k, all_terms).to_pylist()
    for set_no, terms in asked.items():
        want = []
        for i in range(n_pages):
            parts = [idf * tf[i, int(t[1])] * 2.2 / (tf[i, int(t[1])] + 1.2) for t, idf in terms.items() if tf[i, int(t[1])]]
            if parts and (not all_terms or len(parts) == len(terms)):
                want.append((-round(sum(parts), 9), keys[i]))
        got = sorted((-round(r["score"], 9), r["doc_key"]) for r in found if r["set_no"] == set_no)
        assert got[:top_k] == sorted(want)[:top_k] and len(got) <= 4 * top_k


@pytest.mark.parametrize("folder", [True, False])
def test_streamed_table_may_be_a_folder(spark, tmp_path, folder):
    texts = ["mit license software", "another text", "license of software"]
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if folder:
        frame.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    else:
        pq.write_table(frame.toArrow(), tmp_path / "documents.parquet")
    assert queries.streamed_store(spark, str(tmp_path)).search_pages_ranked("license").count() == 2
