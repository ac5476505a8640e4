"""The index and ranked search against a plain computation, and the shape of the plans."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import ranking, segments
from quire.plans.load import LoadOptions, load_files
from quire.plans.store import PageStore
from quire.streaming.ingest import ingest, stream_files


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


WORDS = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]


def corpus(seed=3, pages=120):
    """Words of very different frequency; some pages blank, some equal, one word on nearly all."""
    rng = random.Random(seed)
    out = []
    for n in range(pages):
        count = 0 if n % 17 == 0 else rng.randint(3, 40)
        words = [WORDS[min(int(rng.expovariate(0.12)), len(WORDS) - 1)] for _ in range(count)]
        out.append(" ".join(words + (["common"] * (n % 5) if count else [])))
    out[40] = out[41]
    return out


def score_all(texts, query, k=1.2, b=0.75):
    bags = [Counter(t.split()) for t in texts]
    lengths = [sum(bag.values()) for bag in bags]
    average = sum(lengths) / len(bags)
    scores = {}
    for term in set(query.split()):
        df = sum(term in bag for bag in bags)
        weight = math.log10((len(bags) - df + 0.5) / (df + 0.5) + 1)
        for i, bag in enumerate(bags):
            if term in bag:
                part = weight * bag[term] * (k + 1) / (bag[term] + k * (1 - b + b * lengths[i] / average))
                scores.setdefault(i, []).append(part)
    return scores


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def store(spark, texts, tmp_path_factory):
    store = PageStore(spark, str(tmp_path_factory.mktemp("ranked") / "store"))
    rows = [(i, f"/f{i}.txt", f"f{i}.txt", len(t), f"file {i}\f".encode() + t.encode()) for i, t in enumerate(texts)]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    files = files.withColumn("file_modified_at", F.current_timestamp())
    load_files(store, files, LoadOptions(page_chars=0))
    # Only the second page of each file counts here; the first keeps equal texts apart.
    store.build_index(stemmer=None, stop_words=["file", *[str(i) for i in range(10)]])
    return store


def expected(texts, query, all_terms=False, **parameters):
    n = len(set(query.split()))
    # The first pages are indexed too, with no token: they count in the totals.
    scores = score_all(texts + [""] * len(texts), query, **parameters)
    return {f"f{i}.txt": sum(parts) for i, parts in scores.items() if not all_terms or len(parts) == n}


QUERIES = ["waa", "waa wab", "common", "common waa wfa", "whh wgh common", "waa wab wac wad wae common", "absent", "absent waa"]


@pytest.mark.parametrize(("query", "all_terms", "direct_pairs"), [
    *[(query, False, ranking.DIRECT_PAIRS) for query in QUERIES],
    *[(query, True, ranking.DIRECT_PAIRS) for query in QUERIES[3:6]],
    *[(query, False, 0) for query in QUERIES[3:]],
    (QUERIES[5], True, 0),
])
def test_single_query(store, texts, query, all_terms, direct_pairs):
    want = expected(texts, query, all_terms)
    found = store.search_pages_ranked(query, 7, all_terms, direct_pairs=direct_pairs).collect()
    best = sorted(want.values(), reverse=True)[:7]
    assert [r.score for r in found] == pytest.approx([round(s, 3) for s in best], abs=1e-9)
    assert all(r.page_number == 2 and r.score == pytest.approx(want[r.file_name], abs=6e-4) for r in found)
    assert all(r.snippet == texts[int(r.file_name[1:-4])][:300] for r in found)


@pytest.mark.parametrize("all_terms", [False, True])
@pytest.mark.parametrize("broadcast_rows", [ranking.BROADCAST_ROWS, 0])
def test_batch_equals_plain_computation(spark, store, texts, all_terms, broadcast_rows, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", broadcast_rows)
    asked = QUERIES + ["wab waa", "", "  "]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_id long, query string")
    results = []
    for direct_pairs in (ranking.DIRECT_PAIRS, 0):
        rows = store.search_pages_ranked_batch(queries, 5, all_terms, direct_pairs=direct_pairs).collect()
        results.append(sorted(map(tuple, rows)))
    assert results[0] == results[1]
    for i, query in enumerate(asked):
        want = sorted(expected(texts, query, all_terms).values(), reverse=True)[:5]
        got = [row[4] for row in results[0] if row[0] == i]
        assert got == pytest.approx([round(s, 3) for s in want], abs=1e-9), query


def test_parameters(store, texts):
    found = store.search_pages_ranked("waa wab", 5, k=2.0, b=0.1).collect()
    want = sorted(expected(texts, "waa wab", k=2.0, b=0.1).values(), reverse=True)[:5]
    assert [r.score for r in found] == pytest.approx([round(s, 3) for s in want], abs=1e-9)


@pytest.mark.parametrize("map_side_limit", [1000, 1])
def test_one_group_with_most_rows(spark, map_side_limit, monkeypatch):
    monkeypatch.setattr(ranking, "MAP_SIDE_LIMIT", map_side_limit)
    rows = spark.range(5000).selectExpr(
        "case when id % 3 = 0 then id else -1 end as g", "cast(cast(id as string) as binary) as doc_key",
        "1 as page_number", "cast(id as double) as score",
    )
    top = ranking.top_per_group(rows, ["g"], ranking.best_first(), 4)
    assert (plan(top).count("WindowGroupLimit") > 0) and plan(top).count("Exchange") == (1 if map_side_limit > 1 else 2)
    hot = sorted((r.rank, r.score) for r in top.where("g = -1").collect())
    assert hot == [(1, 4999.0), (2, 4997.0), (3, 4996.0), (4, 4994.0)]
    assert top.count() == 4 + 1667


#: Pages of a made-up bakery manual; every form of "knead" has one stem, "the" is a stop word.
BAKERY = ["Kneading the dough", "The baker kneads", "Proof until doubled", "Knead again; the oven waits", "kneaded, rested, shaped"]


def bakery_files(spark, *names):
    body = "\f".join(BAKERY).encode()
    rows = [(i, f"/{name}", name, len(body), body + f"\f{name}".encode()) for i, name in enumerate(names)]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    return files.withColumn("file_modified_at", F.current_timestamp())


def test_stemming_and_counts(spark, tmp_path):
    store = PageStore(spark, str(tmp_path / "store"))
    load_files(store, bakery_files(spark, "rye.md"), LoadOptions(page_chars=0))
    with pytest.raises(LookupError):
        store.index()
    assert store.build_index() == 6
    rows = store.search_pages_ranked("kneads", top_k=3).collect()
    assert len(rows) == 3 and all(r.score > 0 for r in rows)
    elsewhere = str(tmp_path / "copy")
    assert store.build_index(location=elsewhere) == 6
    found = store.search_pages_ranked("Kneading", location=elsewhere).collect()
    assert sorted(r.page_number for r in found) == [1, 2, 4, 5]
    copied = store.index(elsewhere).pages.drop("segment")
    assert copied.columns == ["page_id", "document_id", "page_number", "page_text"] and copied.count() == 6
    assert store.search_pages_ranked("the").collect() == []
    # A rebuild replaces the index; a deleted document is gone from results before that.
    old = store.index().path
    assert store.build_index() == 6 and store.index().path != old
    store.delete_document(store.documents().first().document_id)
    assert store.search_pages_ranked("oven").collect() == []
    assert store.build_index() == 0
    assert store.search_pages_ranked("oven").collect() == []


def test_plans(spark, store):
    """What a query must not do at scale shows in its plan."""
    scored = plan(ranking.score_pages(store.index(), "waa common"))
    assert "PartitionFilters: [bucket" in scored and "PushedFilters: [In(term" in scored
    assert "Join" not in scored and scored.count("Exchange") == 1
    found = plan(store.search_pages("waa", limit=5))
    assert "TakeOrderedAndProject" in found and "Contains(lower(page_text" in found
    ranked = plan(store.search_pages_ranked("waa common"))
    assert "PushedFilters: [In(document_id" in ranked or "PushedFilters: [Or(" in ranked
    from quire.operators import chunks

    gaps = plan(chunks.chunk_gaps(store.chunks(), store.documents()))
    assert "content" not in gaps
    for shown in (scored, found, ranked, gaps):
        assert "CartesianProduct" not in shown and "BroadcastNestedLoop" not in shown
    postings = plan(ranking.page_postings(store.pages()))
    assert postings.count("regexp") == 0 and "hashpartitioning" not in postings


def scans(frame):
    """The index scans of a plan, as text."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "page_len" in x and "FileScan" in x]


def test_every_form_prunes_folders(spark, store):
    index, documents = store.index(), store.documents()
    queries = spark.createDataFrame([(1, "waa common")], "query_id long, query string")
    for frame in (
        ranking.score_pages(index, "waa common", best=3, direct_pairs=0),
        ranking.score_pages(index, "waa common", best=3, all_terms=True, direct_pairs=0),
        ranking.search_ranked_batch(index, documents, queries, 3),
        ranking.search_ranked_batch(index, documents, queries, 3, direct_pairs=0),
    ):
        found = scans(frame)
        assert found and all("PartitionFilters: [" in x and "PartitionFilters: []" not in x for x in found)


def test_stale_index_in_every_way(spark, texts, tmp_path):
    """Deleted, replaced-with-fewer-pages and re-loaded documents, by single and batch search."""
    store = PageStore(spark, str(tmp_path / "store"))
    rows = [(i, f"/f{i}.txt", f"f{i}.txt", 1, f"common file\fwaa common common {i}\fwab".encode()) for i in range(12)]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    files = files.withColumn("file_modified_at", F.current_timestamp())
    load_files(store, files, LoadOptions(page_chars=0))
    store.build_index(stemmer=None, stop_words=None)
    name = {r.document_id: r.file_name for r in store.documents().collect()}
    ids = {v: k for k, v in name.items()}
    store.delete_documents(spark.createDataFrame([(ids["f3.txt"],), (ids["f4.txt"],)], "document_id string"))
    load_files(store, files.where("ordinal in (4, 5, 6)"), LoadOptions(page_chars=0, replace=True, max_pages=1))
    want = {(f"f{i}.txt", 2) for i in range(12) if i not in (3, 4, 5, 6)}
    want_common = want | {(f"f{i}.txt", 1) for i in range(12) if i != 3}
    queries = spark.createDataFrame([(1, "waa"), (2, "common")], "query_id long, query string")

    def check(*ways):
        for pairs in ways:
            found = store.search_pages_ranked("waa", 50, direct_pairs=pairs).collect()
            assert {(r.file_name, r.page_number) for r in found} == want and len(found) == len(want)
            batch = store.search_pages_ranked_batch(queries, 50, direct_pairs=pairs).collect()
            assert {(r.file_name, r.page_number) for r in batch if r.query_id == 1} == want
            assert {(r.file_name, r.page_number) for r in batch if r.query_id == 2} == want_common

    assert store.live_check(store.index(), store.snapshot()).changed.count() == 4
    check(ranking.DIRECT_PAIRS, 0)
    assert len(store.search_pages_ranked("waa", 3).collect()) == 3
    store.vacuum()
    assert store.live_check(store.index(), store.snapshot()).changed is None
    check(ranking.DIRECT_PAIRS)
    store.build_index(stemmer=None, stop_words=None)
    assert store.live_check(store.index(), store.snapshot()) is None
    assert len(store.search_pages_ranked("waa", 50).collect()) == len(want)


# --- segments -----------------------------------------------------------------------------


def test_merge_plan():
    plan = segments.merges
    assert plan({"a": 5, "b": 5}, set()) == [] and plan({"a": 5, "b": 5}, {"b"}) == [["b"]]
    assert plan({x: 10 for x in "abcd"}, set()) == [["a", "b", "c", "d"]]
    small, large = segments.SMALL_PAGES, segments.SMALL_PAGES * 4
    # Filling a class by merging merges that class as well, in one go; a larger one stays.
    mixed = {**{f"s{i}": small for i in range(4)}, **{f"l{i}": large for i in range(3)}, "huge": large * 100}
    assert plan(mixed, set()) == [["l0", "l1", "l2", "s0", "s1", "s2", "s3"]]


def parts_of(spark, texts, number):
    rows = [(i, f"/f{i}.txt", f"f{i}.txt", 1, f"file {i}\f{t}".encode()) for i, t in enumerate(texts)]
    rows = rows[number * len(rows) // 5 : (number + 1) * len(rows) // 5]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    return files.withColumn("file_modified_at", F.current_timestamp())


ANSWERED = ["waa wab", "common waa wfa", "whh wgh common"]


def test_index_grows_by_segments(spark, texts, store, tmp_path, monkeypatch):
    """Load by load the answers are those of one index over all; old postings are only read to be merged."""
    grown = PageStore(spark, str(tmp_path / "grown"))
    words = {"stemmer": None, "stop_words": ["file", *[str(i) for i in range(10)]]}
    counts = []
    for number in range(5):
        load_files(grown, parts_of(spark, texts, number), LoadOptions(page_chars=0))
        reads = []
        with monkeypatch.context() as m:
            m.setattr(ranking.SearchIndex, "postings", property(lambda self, real=ranking.SearchIndex.postings: reads.append(1) or real.fget(self)))
            assert grown.update_index(**words) == 2 * len(texts) // 5
        assert bool(reads) == (number == segments.FACTOR - 1)
        before = grown.index().path
        assert grown.update_index() == 0 and grown.index().path == before
        counts.append(len(grown.index().segments))
    assert counts == [1, 2, 3, 1, 2]
    folders = {f.rsplit("segment=", 1)[1] for f in grown._folders.matching(f"{grown.root}/index/postings/segment=*")}
    assert {s.segment for s in grown.index().segments} <= folders and len(folders) <= 6
    for query in ANSWERED:
        one, many = (s.search_pages_ranked(query, 9).collect() for s in (store, grown))
        assert [(r.file_name, r.page_number, r.score) for r in many] == [(r.file_name, r.page_number, r.score) for r in one]
    queries = spark.createDataFrame(list(enumerate(ANSWERED)), "query_id long, query string")
    one, many = (sorted((r.query_id, r.rank, r.file_name, r.score) for r in s.search_pages_ranked_batch(queries, 6).collect()) for s in (store, grown))
    assert one == many
    assert [tuple(r) for r in grown.index().stats.collect()] == [tuple(r) for r in store.index().stats.collect()]


@pytest.mark.parametrize("dead_share", [0.1, 1.0])
def test_segments_with_dead_documents(spark, tmp_path, monkeypatch, dead_share):
    """Documents that a later, indexed load deleted or replaced give no rows from older segments, after a vacuum too."""
    monkeypatch.setattr(segments, "DEAD_SHARE", dead_share)
    store = PageStore(spark, str(tmp_path / "store"))
    rows = [(i, f"/f{i}.txt", f"f{i}.txt", 1, f"common file\fwaa common common {i}\fwab".encode()) for i in range(12)]
    files = spark.createDataFrame(rows, "ordinal long, file_path string, file_name string, file_size_bytes long, content binary")
    files = files.withColumn("file_modified_at", F.current_timestamp())
    plain_words = {"stemmer": None, "stop_words": None}
    load_files(store, files.where("ordinal < 8"), LoadOptions(page_chars=0))
    store.update_index(**plain_words)
    load_files(store, files.where("ordinal >= 8"), LoadOptions(page_chars=0))
    ids = {r.file_name: r.document_id for r in store.documents().collect()}
    store.delete_documents(spark.createDataFrame([(ids["f3.txt"],), (ids["f4.txt"],)], "document_id string"))
    load_files(store, files.where("ordinal in (4, 5, 6)"), LoadOptions(page_chars=0, replace=True, max_pages=1))
    store.update_index()
    assert store.live_check(store.index(), store.snapshot()) is None
    assert (store.index().n_dead == 0) == (dead_share < 1)
    want = {(f"f{i}.txt", 2) for i in range(12) if i not in (3, 4, 5, 6)}
    want_common = want | {(f"f{i}.txt", 1) for i in range(12) if i != 3}

    def check():
        for query, pages in (("waa", want), ("common", want_common)):
            found = store.search_pages_ranked(query, 50).collect()
            assert {(r.file_name, r.page_number) for r in found} == pages and len(found) == len(pages)

    check()
    assert dead_share == 1 or store.index().settings.n_pages == store.pages().count()
    store.delete_document(ids["f9.txt"])
    want, want_common = want - {("f9.txt", 2)}, want_common - {("f9.txt", 1), ("f9.txt", 2)}
    check()
    segments_before = len(store.index().segments)
    assert store.update_index() == 0 and len(store.index().segments) == segments_before
    check()
    if dead_share < 1:
        return
    store.vacuum()
    check()
    store.update_index()  # rewritten loads: built anew
    assert len(store.index().segments) == 1 and store.index().n_dead == 0
    check()


def test_copied_index_grows_and_settings_count(spark, tmp_path):
    store, elsewhere = PageStore(spark, str(tmp_path / "store")), str(tmp_path / "index")
    for name in ("rye.md", "spelt.md", "wheat.md", "oat.md", "corn.md"):
        load_files(store, bakery_files(spark, name), LoadOptions(page_chars=0))
        assert store.update_index(elsewhere) == 6
    index = store.index(elsewhere)
    assert [s.copied for s in index.segments] == [True] * 2 and index.pages.count() == 30
    assert len(store.search_pages_ranked("kneading", 50, location=elsewhere).collect()) == 20
    assert store.update_index(elsewhere, stemmer=None, mode="copy") == 30  # other settings: anew
    assert len(store.search_pages_ranked("kneading", 50, location=elsewhere).collect()) == 5


def test_stream_is_searchable(spark, tmp_path):
    """Every batch adds its segment; a load that lost its indexing gets it from the replay, which adds nothing twice."""
    folder = tmp_path / "in"
    folder.mkdir()
    store = PageStore(spark, str(tmp_path / "store"))
    settings = {"stemmer": "english", "stop_words": None}
    run = lambda: ingest(store, stream_files(spark, str(folder), "md"), str(tmp_path / "cp"), LoadOptions(), index=settings).awaitTermination()
    for number, name in enumerate(("rye.md", "oat.md"), start=1):
        (folder / name).write_text("\f".join([*BAKERY, name]))
        run()
        assert {r.file_name for r in store.search_pages_ranked("kneads", 50).collect()} == {"rye.md", "oat.md"} - ({"oat.md"} if number == 1 else set())
    assert len(store.index().segments) == 2
    path = store.index().path
    again = ingest(store, stream_files(spark, str(folder), "md"), str(tmp_path / "other"), LoadOptions(), index=settings)
    again.awaitTermination()
    assert store.index().path == path and store.pages().count() == 12
    load_files(store, bakery_files(spark, "lost.md"), LoadOptions(page_chars=0))  # not indexed
    (folder / "late.md").write_text("Kneads late")
    run()
    assert {r.file_name for r in store.search_pages_ranked("kneads", 50).collect()} == {"rye.md", "oat.md", "lost.md", "late.md"}


def test_ranked_search_in_sql(spark, store, texts):
    store.register_sql("r_")
    for query, k in (("waa wab", 7), ("common", 3), ("absent", 4), ("", 4), ("WAA  wáa", 5)):
        plain = [tuple(r) for r in store.search_pages_ranked(query, k).collect()]
        assert [tuple(r) for r in spark.sql(f"SELECT * FROM r_search_pages_ranked('{query}', {k})").collect()] == plain, query
    assert spark.sql("SELECT r_search_terms('Naïve the-THE') AS t").first().t == ["naive", "the", "the"]
    joined = spark.sql("SELECT d.file_name, count(*) AS n FROM r_search_pages_ranked('waa wab') h JOIN r_documents d USING (document_id) GROUP BY 1")
    assert joined.count() == 20


def test_stemmed_ranked_search_in_sql(spark, tmp_path):
    store = PageStore(spark, str(tmp_path / "store"))
    load_files(store, bakery_files(spark, "rye.md", "oat.md"), LoadOptions(page_chars=0))
    store.build_index()
    store.register_sql("b_")
    plain = [tuple(r) for r in store.search_pages_ranked("the kneads oven").collect()]
    assert len(plain) == 8 and [tuple(r) for r in spark.sql("SELECT * FROM b_search_pages_ranked('the kneads oven')").collect()] == plain
    # A store without an index has no such function.
    empty = PageStore(spark, str(tmp_path / "empty"))
    empty.ensure_tables()
    empty.register_sql("e_")
    with pytest.raises(Exception, match="e_search_pages_ranked"):
        spark.sql("SELECT * FROM e_search_pages_ranked('x')")
