"""Secret scans: fixed formats, and random-looking strings by two character Markov models.

Everything on the scanning path is an expression on the row's own text: no Python, no shuffle, and
work in proportion to the text. One first-order Markov model is counted on random strings and one on
ordinary identifiers, from labelled samples; a token is a secret when the log-likelihood ratio of the
two outweighs the odds against a token being random.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import let

#: Fixed formats: kind, pattern, group whose length counts, least length. Kinds in sort order.
FORMATS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
MARKOV = "markov"
MASK = "<SECRET>"

#: Characters of tokens that the models judge, and the least length of such a token.
TOKEN = "[A-Za-z0-9+/_=-]"
LEAST_TOKEN = 12
#: Ordinary identifiers are learned from tokens of this length on.
LEAST_IDENTIFIER = 6
#: Odds against a long token being random, as a logarithm: the ratio has to outweigh them.
LOG_ODDS = math.log(1e6)

_CODES = 128
_BLOCK = 256
#: Characters of the blocks that texts are cut into.
_CUT = 2_048


def _running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` gathers from ``start`` on, up to and with each element."""
    zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(values, zero, lambda acc, x: F.struct(
        step(acc["at"], x).alias("at"), F.array_append(acc["all"], step(acc["at"], x)).alias("all")
    ))["all"]


def _with_running(df: DataFrame, values: str, out: str, step: Callable[[Column, Column], Column]) -> DataFrame:
    """``out``: running sums or maxima of the array ``values``; in blocks, so that a long array costs little more than its length."""
    zero, size = F.lit(0), F.size(values)
    numbers = F.sequence(zero, F.greatest(F.floor((size - 1) / _BLOCK).cast("int"), zero))
    blocks = F.transform(numbers, lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    df = df.withColumn(out, F.when(F.col(values).isNotNull(), blocks))
    starts = F.concat(F.array(zero), _running(F.transform(out, lambda x: F.aggregate(x, zero, step)), zero, step))
    # The last start has no block; arguments of zip_with are worked out once, a lambda's body for each element.
    ends = F.flatten(F.zip_with(out, F.slice(starts, F.lit(1), F.size(out)), lambda block, start: _running(block, start, step)))
    return df.withColumn(out, F.when(F.col(out).isNotNull(), ends))


def spans(df: DataFrame, text: str, pattern: str, group: int, out: str) -> DataFrame:
    """``df`` with ``out``: array of (start, end, value) of the leftmost non-overlapping matches.

    Positions count code points, ends are exclusive, ``value`` is the group's string. Matches and
    the gaps between them cover the text, so their lengths add up to the positions.
    """
    regex, found, lengths, ends = F.lit(pattern), f"{out}_parts", f"{out}_lengths", f"{out}_ends"
    parts = F.struct(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("values"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    df = df.withColumn(found, F.when(F.col(text).rlike(pattern), parts))
    matches, values, gaps = (F.col(found)[name] for name in ("matches", "values", "gaps"))
    df = df.withColumn(lengths, F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m)))
    df = _with_running(df, lengths, ends, lambda a, b: a + b)
    spanned = F.transform(
        F.arrays_zip(matches.alias("m"), values.alias("v"), F.col(ends).alias("e")),
        lambda x: F.struct((x["e"] - F.length(x["m"])).alias("start"), x["e"].alias("end"), x["v"].alias("value")),
    )
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return df.withColumn(out, F.coalesce(spanned, none)).drop(found, lengths, ends)


def _formats(df: DataFrame, text: str) -> DataFrame:
    """``_base``: the spans of the fixed formats as (start, kind number, kind, end, value), sorted."""
    every = []
    for number, (kind, pattern, group, least) in enumerate(FORMATS):
        df = spans(df, text, pattern, group, f"_{kind}")
        df = df.withColumn(f"_{kind}", F.filter(f"_{kind}", lambda s: F.length(s["value"]) >= least))
        every.append(F.transform(f"_{kind}", lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("number"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value")
        )))
    return df.withColumn("_base", F.array_sort(F.concat(*every)))


def _woven(df: DataFrame, text: str, found: str, out: str, filler: Callable[[Column, Column], Column]) -> DataFrame:
    """``out``: ``text`` with ``filler(span, end before)`` in the place of what the sorted spans ``found`` cover.

    ``end before`` is the largest end of the earlier spans. The text is cut into blocks once, and
    a gap is taken from the few blocks that it lies in.
    """
    blocks, ends, before = f"{out}_blocks", f"{out}_ends", f"{out}_before"
    some = F.size(found) > 0
    df = df.withColumn(blocks, F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0))))
    df = df.withColumn(before, F.when(some, F.transform(found, lambda s: s["end"])))
    df = _with_running(df, before, ends, lambda a, b: F.greatest(a, b))
    df = df.withColumn(before, F.when(some, F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))))

    def between(held: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / _CUT).cast("int"), F.floor((end - 1) / _CUT).cast("int")
        whole = F.transform(F.sequence(first, last), lambda b: F.substr(
            F.get(held, b), F.greatest(start - b * _CUT, F.lit(0)) + 1, F.least(end - b * _CUT, F.lit(_CUT)) - F.greatest(start - b * _CUT, F.lit(0))
        ))
        return F.when(start < end, F.concat_ws("", whole)).otherwise("")

    def whole(held: Column) -> Column:
        pieces = F.zip_with(found, before, lambda s, at: F.concat(between(held, at, s["start"]), filler(s, at)))
        return F.concat(F.concat_ws("", pieces), between(held, F.element_at(ends, -1), F.length(text)))

    woven = let(F.col(blocks), whole)
    return _settled(df, F.when(some, woven).otherwise(F.col(text)), out).drop(blocks, ends, before)


def _settled(df: DataFrame, value: Column, out: str) -> DataFrame:
    """``df`` with ``out``, by a generator of one row: a later filter on it would else be copied through all that it is made of."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.explode(F.array(value)).alias(out))


def _uncovered(df: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: ``text`` with blanks in the place of the spans ``_base``, so that positions stay."""
    return _woven(df, text, "_base", out, lambda s, at: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at))))


def labelled_tokens(spark: SparkSession, df: DataFrame, text: str = "text", generated: int = 2_000) -> DataFrame:
    """(token, is_random, n): the labelled samples of all texts of ``df``, and how often each occurs.

    Random: the strings that the fixed formats find, and ``generated`` digests in each of three
    usual alphabets, so that formats which the texts lack are covered. Ordinary: the tokens outside of them.
    """
    found = _formats(df.select(F.col(text).alias("_text")).where("_text IS NOT NULL"), "_text")
    found = _uncovered(found, "_text", "_rest")
    pattern = F.lit(f"{TOKEN}{{{LEAST_IDENTIFIER},}}")
    labelled = lambda array, random: F.transform(array, lambda x: F.struct(x.alias("token"), F.lit(random).alias("is_random")))
    base, rest = F.transform("_base", lambda s: s["value"]), F.regexp_extract_all("_rest", pattern, F.lit(0))
    seen = found.select(F.explode(F.concat(labelled(base, True), labelled(rest, False))).alias("s")).select("s.*")
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 256))
    made = spark.range(generated).select(
        F.explode(F.array(F.base64(digest), F.translate(F.base64(digest), "+/=", "-_"), F.lower(F.hex(digest)))).alias("token"),
        F.lit(True).alias("is_random"),
    )
    return seen.unionByName(made).groupBy("is_random", "token").agg(F.count("*").alias("n"))


def _codes(token: Column) -> Column:
    return F.transform(F.slice(F.split(token, ""), F.lit(1), F.length(token)), lambda c: F.least(F.ascii(c), F.lit(_CODES - 1)))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratios of all pairs of neighbouring ASCII characters, random over ordinary.

    ``samples`` is (token, is_random), with a count ``n`` where a row stands for several. Pairs are
    counted by Spark; what comes back has at most two rows for each of 128 * 128 pairs. Without samples
    every ratio is 0.
    """
    times = F.col("n") if "n" in samples.columns else F.lit(1)
    usable = samples.where((F.length("token") > 1) & F.col("is_random").isNotNull())
    pairs = usable.select("is_random", times.alias("n"), F.explode(_pairs(F.col("token"))).alias("pair"))
    counts = {True: [0] * _CODES**2, False: [0] * _CODES**2}
    for row in pairs.groupBy("is_random", "pair").agg(F.sum("n").alias("n")).collect():
        counts[row["is_random"]][row["pair"]] = row["n"]

    def logs(of: list[int]) -> list[float]:
        sums = [sum(of[a * _CODES : (a + 1) * _CODES]) + smoothing * _CODES for a in range(_CODES)]
        return [math.log((n + smoothing) / sums[i // _CODES]) for i, n in enumerate(of)]

    return [a - b for a, b in zip(logs(counts[True]), logs(counts[False]), strict=True)]


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of neighbouring characters."""
    last = F.length(token) - 1
    return let(_codes(token), lambda c: F.zip_with(F.slice(c, F.lit(1), last), F.slice(c, F.lit(2), last), lambda a, b: a * _CODES + b))


def _is_random(token: Column, ratios: Sequence[float]) -> Column:
    """Whether the log-likelihood ratio of a token, the sum over its pairs, outweighs the odds.

    So must the sum over its distinct pairs: rulers and repeats, in which one pair comes again and
    again, are nothing that models of single steps can tell.
    """
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to a constant
    ratio = lambda pairs: F.aggregate(pairs, F.lit(0.0), lambda total, pair: total + table[pair])
    return let(_pairs(token), lambda pairs: (ratio(pairs) >= LOG_ODDS) & (ratio(F.array_distinct(pairs)) >= LOG_ODDS))


def scan(df: DataFrame, ratios: Sequence[float], text: str = "text") -> DataFrame:
    """``df`` with ``secrets``: sorted array of (start, number, kind, end, value) of each whole text.

    Kinds are the fixed formats and then ``markov``: what the spans of the fixed formats leave of
    the text is cut into tokens, and those of ``LEAST_TOKEN`` characters or more are judged, also the rest of
    a token that a fixed format covers in part. A span is given where the log-likelihood ratio is at
    least ``LOG_ODDS``, repeated pairs left out as well as counted. A null or empty text has no spans; a column ``secrets`` is replaced. Rows are
    independent of each other, so copies and repeated rows get the same spans.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text")]
    found = _uncovered(_formats(df.select(*row), "_text"), "_text", "_rest")
    found = spans(found, "_rest", f"{TOKEN}{{{LEAST_TOKEN},}}", 0, "_long")
    random = F.filter("_long", lambda s: _is_random(s["value"], ratios))
    more = F.transform(random, lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(FORMATS)).alias("number"), F.lit(MARKOV).alias("kind"), s["end"].alias("end"), s["value"].alias("value")
    ))
    every = F.when(F.size("_more") > 0, F.array_sort(F.concat("_base", "_more"))).otherwise(F.col("_base"))
    found = _settled(found.select("_row", "_base", "_long", more.alias("_more")), every, "_every")
    return found.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != "secrets"], F.col("_every").alias("secrets"))


def is_base(span: Column) -> Column:
    return span["kind"] != MARKOV


def listed(found: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def with_masked(df: DataFrame, text: str = "text", found: str = "secrets", out: str = "masked") -> DataFrame:
    """``df`` with ``out``: ``text`` with each run of overlapping spans replaced by one mask; null stays null."""
    return _woven(df, text, found, out, lambda s, at: F.when(s["start"] >= at, MASK).otherwise(""))
