"""Posting lists on their way to the tasks that write them, and the loads of the store of segments."""

from pyspark.sql import functions as F

from quire.operators import ranking
from quire.plans import queries

COLUMNS = ["block", "term", "doc_keys", "page_number", "tf", "page_len", "df", "total_tf", "max_tf", "min_len"]


def plain(rows):
    return sorted(tuple([bytes(k) for k in v] if c == "doc_keys" else v for c, v in zip(COLUMNS, r)) for r in rows.select(*COLUMNS).collect())


def pages_of(spark, n_pages, n_words):
    """Pages of ``n_words`` different words; a document has three pages."""
    word = F.translate((F.col("id") * 7 + F.col("at") * 11).cast("string"), "0123456789", "abcdefghij")
    rows = spark.range(0, n_pages, 1, 3).withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(n_words - 1))))
    texts = rows.groupBy("id").agg(F.concat_ws(" ", F.collect_list(word), F.lit("common common")).alias("page_text"))
    key = F.md5(F.floor(F.col("id") / 3).cast("string"))
    cuts = [F.substring(key, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return texts.select(F.concat_ws("-", *cuts).alias("document_id"), (F.col("id") % 3 + 1).cast("int").alias("page_number"), "page_text")


def test_parcels_give_back_the_lists(spark):
    pages = pages_of(spark, 200, 9).coalesce(3)
    lists = ranking.page_postings(pages).localCheckpoint()
    want = plain(lists)
    packed = ranking.parcels(lists, 8, 3)
    assert plain(ranking.deliver(packed, 8, 3)) == want
    got = ranking.deliver(packed, 8, 3).select("term", "bucket", F.spark_partition_id().alias("at")).collect()
    expected = {r.term: r.b for r in lists.select("term", ranking.bucket_of(F.col("term"), 8).alias("b")).collect()}
    assert all(r.bucket == expected[r.term] and r.at // 3 == r.bucket for r in got)
    assert plain(ranking.deliver(ranking.page_parcels(pages, [], None, 8, 3), 8, 3)) == plain(ranking.page_postings(pages))
    assert ranking.deliver(ranking.parcels(lists.where("false"), 8, 3), 8, 3).count() == 0


def test_a_page_key_is_not_shuffled_with_each_posting(spark):
    """16 random bytes a posting do not compress; a parcel holds the key of a page once."""
    packed = ranking.page_parcels(pages_of(spark, 1000, 150).coalesce(1), [], None, 8, 1)
    assert packed.agg(F.sum(F.length("parcel"))).first()[0] < 8 * 1000 * 150


def test_parts_grow_with_the_pages():
    for n_pages in (1, 80_000, 5_000_000, 300_000_000):
        buckets = ranking.bucket_count(n_pages)
        tasks = buckets * ranking.bucket_parts(n_pages, buckets)
        assert n_pages / ranking.PAGES_PER_TASK <= tasks <= n_pages / ranking.PAGES_PER_TASK + buckets


def test_loads_of_the_segmented_store_skip_row_groups(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}", "en", "web", 6) for i in [*range(0, 23, 2), 23]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    taken = []
    monkeypatch.setattr(queries, "load_files", lambda store, files, options: taken.append(files))
    monkeypatch.setattr(queries.PageStore, "update_index", lambda *args, **kept: 0)
    queries.segmented_store(spark, str(tmp_path))
    for number, files in enumerate(taken):
        assert "GreaterThanOrEqual(doc_id" in files._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.ordinal for r in files.select("ordinal").collect()) == [r[0] for r in rows if r[0] * queries.PARTS // 24 == number]
    assert len(taken) == queries.PARTS
