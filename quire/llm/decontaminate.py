"""Benchmark decontamination by winnowing, in DataFrame operations alone.

The smallest k-gram hash of every sliding window is a fingerprint. A window of ``span`` words
holds exactly ``span - k + 1`` k-grams, so any shared span of that length has a fingerprint in
common on both sides. Fingerprints are joined, and each hit is extended: the spans around it are
compared as a whole. Items too short for that are compared at every position instead: hashes of
all runs of their lengths are tested against a filter of fixed size within the row of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import WORD, ascii_lower, comma_sha256, keyed, with_found, written

SPAN = 10
GRAM = 5
#: Fingerprints of items that are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Bits of the filter of short items' hashes, whatever their number; 64 to a cell.
FILTER_BITS = 1 << 20


def _hashes(text: str) -> Column:
    """64-bit hashes of a text's words; none for null."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def _up_to(last: Column) -> Column:
    """0 to ``last``, empty where that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _grams(words: str) -> Column:
    """All k-grams as one integer each: 32 bits of hash above the position, so the smallest is the first smallest."""
    return F.transform(
        _up_to(F.size(words) - GRAM),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(GRAM)]).bitwiseAND(F.lit(-1 << 32)).bitwiseOR(i.cast("long")),
    )


def _winnowed(grams: str) -> Column:
    """Fingerprints: the smallest k-gram of every window of k-grams, each once."""
    width = SPAN - GRAM + 1
    return F.array_distinct(F.transform(_up_to(F.size(grams) - width), lambda i: F.array_min(F.slice(grams, i + 1, F.lit(width)))))


def _hash(fingerprint: Column) -> Column:
    return F.shiftright(fingerprint, 32)


def _same(words: Column) -> list[Column]:
    """Two independent hashes of a run of words: equal runs agree in both."""
    return [F.xxhash64(words).alias("h1"), F.xxhash64(F.lit("second"), words).alias("h2")]


def _windows(df: DataFrame, keys: list[str], length: Column) -> DataFrame:
    """(keys, start, length, h1, h2) of every run of ``length`` words."""
    at = df.select(*keys, "words", length.alias("length"), F.explode(_up_to(F.size("words") - length)).alias("start"))
    return at.select(*keys, "start", "length", *_same(F.slice("words", F.col("start") + 1, F.col("length"))))


def _spans_at(spot: Column, length: int) -> Column:
    return F.transform(_up_to(F.size(spot) - length), lambda i: F.struct(i.alias("skip"), *_same(F.slice(spot, i + 1, F.lit(length)))))


def _spots(docs: DataFrame) -> DataFrame:
    """(doc keys, hash, n_words, from, spot): fingerprints with the words that the spans around them can reach.

    One more row for each text has no spot; it carries the number of words.
    """
    have = docs.select("doc_id", "text_key", _hashes("text").alias("words"))
    found = have.withColumn("grams", _grams("words")).withColumn("found", _winnowed("grams"))
    before = SPAN - GRAM
    size = F.size("words").cast("long")

    def spot(f: Column) -> Column:
        at = f.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
        first = F.greatest(at - before, F.lit(0))
        return F.struct(
            _hash(f).alias("hash"), F.lit(None).cast("long").alias("n_words"), first.alias("from"),
            F.slice("words", first + 1, at + SPAN - first).alias("spot"),
        )

    text = F.struct(
        F.col("text_key").alias("hash"), size.alias("n_words"), F.lit(None).cast("int").alias("from"), F.lit(None).cast("array<bigint>").alias("spot")
    )
    return found.select("doc_id", "text_key", F.explode(F.concat(F.array(text), F.transform("found", spot))).alias("f")).select("doc_id", "text_key", "f.*")


def _bit(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(FILTER_BITS))


def _filter(windows: DataFrame) -> Column:
    """The bits of the windows' hashes as one array of ``FILTER_BITS`` / 64 integers: a scalar subquery."""
    bits = windows.select(_bit(F.col("h1")).alias("bit"))
    set_ = bits.groupBy(F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    cells = windows.sparkSession.range(FILTER_BITS // 64).withColumnRenamed("id", "cell").join(set_, "cell", "left")
    row = cells.agg(F.array_sort(F.collect_list(F.struct("cell", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("cells"))
    return row.select(F.col("cells.bits")).scalar()


def _short(rows: DataFrame, keys: list[str], windows: DataFrame) -> DataFrame | None:
    """(keys, start, length, h1, h2): runs of fewer than ``SPAN`` words that pass the items' filter; None without short items.

    The texts are read once for all lengths, and only runs that pass are exploded.
    """
    short = windows.where(F.col("length") < SPAN)
    lengths = sorted(row["length"] for row in short.select("length").distinct().collect())  # fewer than SPAN rows
    if not lengths:
        return None
    have = rows.select(*keys, _hashes("text").alias("words"), _filter(short).alias("filter"))

    def known(start: Column, n: int) -> Column:
        bit = _bit(F.xxhash64(F.slice("words", start + 1, F.lit(n))))
        return F.getbit(F.get("filter", F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1

    def runs(n: int) -> Column:
        starts = F.filter(_up_to(F.size("words") - n), lambda i: known(i, n))
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(n).alias("length"), *_same(F.slice("words", i + 1, F.lit(n)))))

    passed = F.concat(*[runs(n) for n in lengths])
    return have.select(*keys, F.explode(passed).alias("s")).select(*keys, "s.*")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_key, n_words, n_hit, items array of item_ids as strings): one row per row of ``docs``.

    A window is ``SPAN`` consecutive words of an item (all words of a shorter item, none of one
    without words); ``n_hit`` counts the words of a text inside any occurrence of a window, and
    ``items`` are those with such windows, sorted. A null text has no words; a null item text has
    no windows. Rows are told apart by id and text, so repeated ids keep their own results;
    null ids match each other. Empty ``items`` leave all clean. Items with one id are one item.

    The text is read once (once more, if any item has fewer than ``SPAN`` words), and only hits and one small row for each text are shuffled as long
    as the items' fingerprints are few enough to be broadcast (``BROADCAST_ROWS``, counted);
    with more of them all fingerprints of texts are shuffled.
    """
    rows, keys, size = keyed(docs, key, text), ["doc_id", "text_key"], F.size("words")
    asked = items.select(F.col("item_id").cast("string").alias("item_id"), _hashes("text").alias("words")).where(size > 0)
    windows = _windows(asked, ["item_id"], F.least(size, F.lit(SPAN))).select("item_id", "length", "h1", "h2").distinct()
    found = asked.withColumn("grams", _grams("words")).select(F.explode(_winnowed("grams")).alias("f"))
    marks = found.select(_hash(F.col("f")).alias("hash")).distinct().withColumn("known", F.lit(True))
    if marks.count() <= BROADCAST_ROWS:
        marks = F.broadcast(marks)
    hit = _spots(rows).join(marks, "hash", "left").where("known OR spot IS NULL").drop("hash", "known")
    hit = written(hit, "decontaminate-hits")

    near = hit.where("spot IS NOT NULL").select(*keys, "from", F.explode(_spans_at(F.col("spot"), SPAN)).alias("s"))
    near = near.select(*keys, (F.col("from") + F.col("s.skip")).alias("start"), F.lit(SPAN).alias("length"), "s.h1", "s.h2").distinct()
    short = _short(rows, keys, windows)
    if short is not None:
        near = near.unionByName(short)
    found = near.join(windows, ["length", "h1", "h2"]).select(*keys, "item_id", "start", "length").distinct()
    places = found.select(*keys, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    n_hit = places.groupBy(*keys).agg(F.count("*").alias("n_hit"))
    listed = found.groupBy(*keys).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    counted = hit.where("spot IS NULL").select(*keys, "n_words")
    return with_found(counted, with_found(n_hit, listed)).select(
        F.col("doc_id").alias(key), "text_key", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        comma_sha256(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
