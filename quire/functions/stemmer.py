"""English stemming by the published Snowball "English" (Porter2) rules.

The rules run once per distinct word of an Arrow batch, with a memo per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published algorithm.
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
SPECIAL_PREFIXES = ("gener", "commun", "arsen")
SPECIAL_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
LEFT_AFTER_PLURALS = (
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
)
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)

_AFTER_VOWEL_GROUP = re.compile(r"[aeiouy][^aeiouy]")
_HAS_VOWEL = re.compile(r"[aeiouy]")
_SHORT_TAIL = re.compile(r"(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _regions(word: str) -> tuple[int, int]:
    prefix = next((p for p in SPECIAL_PREFIXES if word.startswith(p)), None)
    if prefix:
        r1 = len(prefix)
    else:
        hit = _AFTER_VOWEL_GROUP.search(word)
        r1 = hit.end() if hit else len(word)
    hit = _AFTER_VOWEL_GROUP.search(word, r1)
    return r1, hit.end() if hit else len(word)


def _longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


def _plurals(word: str) -> str:
    ending = _longest(word, ("sses", "ied", "ies", "us", "ss", "s"))
    if ending == "sses":
        return word[:-2]
    if ending in ("ied", "ies"):
        return word[:-2] if len(word) > 4 else word[:-1]
    if ending == "s" and _HAS_VOWEL.search(word, 0, len(word) - 2):
        return word[:-1]
    return word


def _past_and_gerund(word: str, r1: int) -> str:
    ending = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if ending is None:
        return word
    stem = word[: -len(ending)]
    if ending.startswith("eed"):
        return stem + "ee" if len(stem) >= r1 else word
    if not _HAS_VOWEL.search(stem):
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if stem.endswith(DOUBLES):
        return stem[:-1]
    if r1 >= len(stem) and _SHORT_TAIL.search(stem):
        return stem + "e"
    return stem


def _derivations(word: str, r1: int, r2: int) -> str:
    ending = _longest(word, STEP2)
    if ending and len(word) - len(ending) >= r1:
        stem = word[: -len(ending)]
        if ending == "li":
            allowed = stem[-1:] != "" and stem[-1] in LI_ENDINGS
        else:
            allowed = ending != "ogi" or stem.endswith("l")
        if allowed:
            word = stem + STEP2[ending]
    ending = _longest(word, STEP3)
    if ending and len(word) - len(ending) >= (r2 if ending == "ative" else r1):
        word = word[: -len(ending)] + STEP3[ending]
    ending = _longest(word, STEP4)
    if ending and len(word) - len(ending) >= r2:
        if ending != "ion" or word[-4:-3] in ("s", "t"):
            word = word[: -len(ending)]
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _SHORT_TAIL.search(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word


@lru_cache(maxsize=1 << 16)
def stem_english(word: str) -> str:
    if word in SPECIAL_WORDS:
        return SPECIAL_WORDS[word]
    if len(word) <= 2:
        return word
    # A consonant y is written as a capital while the rules run.
    word = re.sub(r"^y|(?<=[aeiouy])y", "Y", word)
    r1, r2 = _regions(word)
    word = _plurals(word)
    if word in LEFT_AFTER_PLURALS:
        return word
    word = _past_and_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    return _derivations(word, r1, r2).lower()


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_arrays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Stem every word of arrays of words; Python touches each distinct word of a batch once."""
    for lists in batches:
        encoded = lists.flatten().dictionary_encode()
        stems = pa.array([stem_english(word) for word in encoded.dictionary.to_pylist()], pa.string())
        words = stems.take(encoded.indices)
        sizes = pc.fill_null(pc.list_value_length(lists), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        yield pa.ListArray.from_arrays(offsets, words, mask=lists.is_null() if lists.null_count else None)
