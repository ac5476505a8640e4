"""Tokeniser of the search index, as row-local column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: everything outside a-z separates tokens (after lower-casing and accent removal).
SEPARATOR = "[^a-z]+"


@cache
def _accent_table() -> tuple[str, str]:
    """Lower-case Latin letters that decompose to a-z, then the combining marks (dropped)."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter.islower() and "a" <= base <= "z":
            source.append(letter)
            target.append(base)
    marks = [chr(code) for code in range(0x300, 0x370)]
    return "".join(source + marks), "".join(target)


def normalise(text: Column) -> Column:
    """Lower case without accents. Pure ASCII text, told by its length in bytes, skips the table."""
    source, target = _accent_table()
    lowered = F.lower(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, lowered).otherwise(F.translate(lowered, source, target))


def tokens(text: Column) -> Column:
    return F.filter(F.split(normalise(text), SEPARATOR), lambda token: token != "")


def terms_sql(text: str) -> str:
    """``tokens`` as SQL, for functions that SQL users call."""
    source, target = _accent_table()
    return f"filter(split(translate(lower({text}), '{source}', '{target}'), '{SEPARATOR}'), t -> t <> '')"


def remove_stop_words(token_array: Column, stop_words: list[str]) -> Column:
    if not stop_words:
        return token_array
    return F.filter(token_array, lambda token: ~token.isin(stop_words))


def stop_word_list(spark: SparkSession, stop_words: str | list[str] | None) -> list[str]:
    """``None``/``"none"``: no list; a language name: Spark ML's own list; else the given words."""
    if stop_words is None or stop_words == "none":
        return []
    if isinstance(stop_words, str):
        from pyspark.ml.feature import StopWordsRemover

        return sorted(StopWordsRemover.loadDefaultStopWords(stop_words))
    return sorted(set(stop_words))


def with_term_counts(df: DataFrame, token_column: str, out: str = "term_counts") -> DataFrame:
    """Add ``out``: array of (term, tf) for the tokens of each row, with no shuffle.

    The tokens are sorted inside the row and the starts of equal runs are kept; each run's
    length is its term frequency.
    """
    start_at = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    runs = F.transform(
        F.col("_starts"),
        lambda start, j: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_starts", j + 1), F.size("_sorted")) - start).alias("tf"),
        ),
    )
    return (
        df.withColumn("_sorted", F.sort_array(token_column))
        .withColumn("_starts", F.when(F.size("_sorted") > 0, start_at))
        .withColumn(out, runs)
        .drop("_sorted", "_starts")
    )
