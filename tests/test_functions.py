"""Column expressions against plain Python."""

import hashlib
import mimetypes
import random
import uuid
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from quire.functions import identity, mime, text, tokens
from quire.functions.pdf_dates import parse_pdf_date
from quire.functions.stemmer import stem_arrays, stem_english


def evaluate(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    out = rows.select("i", expression(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(out, key=lambda row: row.i)]


def moments(spark, values):
    found = evaluate(spark, values, lambda v: F.unix_micros(parse_pdf_date(v)))
    return [None if us is None else datetime.fromtimestamp(us / 1e6, timezone.utc) for us in found]


def test_dates(spark):
    cases = {
        "D:20250609143818+09'00'": datetime(2025, 6, 9, 5, 38, 18, tzinfo=timezone.utc),
        "D:20240704151138-05'30'": datetime(2024, 7, 4, 20, 41, 38, tzinfo=timezone.utc),
        "D:20240704151138Z": datetime(2024, 7, 4, 15, 11, 38, tzinfo=timezone.utc),
        "D:2024": datetime(2024, 1, 1, tzinfo=timezone.utc),
        "\u00a0 D:2024 \n": datetime(2024, 1, 1, tzinfo=timezone.utc),
        "D:20241 and more": datetime(2024, 1, 1, tzinfo=timezone.utc),
        "D:202402+03": datetime(2024, 1, 31, 21, tzinfo=timezone.utc),
        "D:20240704151138+": datetime(2024, 7, 4, 15, 11, 38, tzinfo=timezone.utc),
        "": None, "not a date": None, "D:20241399": None, "D:20240230": None, "D:202407041511 60": datetime(
            2024, 7, 4, 15, 11, tzinfo=timezone.utc),
        "D:20240704151160": None, "D:00000101": None, "D:20240704151138+24'00'": None, "d:2024": None,
        "\x012024\x0101\x01": None, "D:\x012024": None,
    }
    assert moments(spark, [*cases, None]) == [*cases.values(), None]


def test_random_dates(spark):
    rng = random.Random(7)
    values, expected = [], []
    for _ in range(400):
        parts = [rng.randint(1, 9998), rng.randint(0, 14), rng.randint(0, 32), rng.randint(0, 25),
                 rng.randint(0, 61), rng.randint(0, 61)][: rng.randint(1, 6)]
        raw = "D:" + "".join(f"{p:04d}" if i == 0 else f"{p:02d}" for i, p in enumerate(parts))
        filled = parts + [1, 1, 0, 0, 0][len(parts) - 1:]
        sign, hours, minutes = rng.choice("+-Z"), rng.randint(0, 23), rng.randint(0, 59)
        offset = timedelta(hours=hours, minutes=minutes) * {"+": 1, "-": -1, "Z": 0}[sign]
        values.append(raw + (sign if sign == "Z" else f"{sign}{hours:02d}'{minutes:02d}'"))
        try:
            expected.append(datetime(*filled, tzinfo=timezone.utc) - offset)
        except (ValueError, OverflowError):
            expected.append(None)
    assert moments(spark, values) == expected


def test_document_ids(spark):
    namespace = uuid.UUID(identity.DOCUMENT_ID_NAMESPACE)
    hashes = ["ab" * 32, "cd" * 32, *[hashlib.sha256(str(i).encode()).hexdigest() for i in range(200)]]
    found = evaluate(spark, hashes, identity.document_id)
    assert found == [str(uuid.uuid5(namespace, h)) for h in hashes]
    assert evaluate(spark, [None], identity.document_id) == [None]
    back = evaluate(spark, found, lambda v: identity.document_of_key(identity.document_key(v)))
    assert back == found


def test_blank_and_strip(spark):
    values = ["", " ", "\t\n", "\u00a0", "\u3000\u0085", "\x1c\x1f", "\u200b", " x ", "\f", None]
    found = evaluate(spark, values, text.is_nonblank)
    assert found == [bool(v and v.strip()) for v in values]
    assert evaluate(spark, values[:-1], text.strip) == [v.strip() for v in values[:-1]]
    assert evaluate(spark, ["  a\n\n b\u3000c "], text.squeeze) == ["a b c"]


def test_contains_term(spark):
    values = ["Relief VALVE", r"a\b", "50% off", "x_y", "", None]
    look = lambda term: evaluate(spark, values, lambda v: text.contains_term(v, term))
    assert look("relief valve") == [True, False, False, False, False, None]
    assert look("a\\b") == [False, True, False, False, False, None]
    assert look("0%o") == [False, False, True, False, False, None]
    assert look("x_y") == [False, False, False, True, False, None]
    assert look("") == [True, True, True, True, True, None]
    assert look(None) == [None] * 6


def test_snippets(spark):
    body = "a" * 200 + "Needle" + "b" * 400
    found = evaluate(spark, [body], lambda v: text.snippet_around(v, "nEEDLE"))[0]
    assert found == body[200 - 120 : 200 - 120 + 300]
    assert evaluate(spark, [body], lambda v: text.snippet_around(v, "N%le"))[0] == body[:300]
    assert evaluate(spark, [body], text.snippet_head)[0] == body[:300]


def test_fixed_size_pages(spark):
    values = ["", "x" * 7, "\n\f\U0001f600é" * 5, "y" * 6]
    found = evaluate(spark, values, lambda v: text.fixed_size_pages(v, 3))
    assert found == [[v[i:i + 3] for i in range(0, len(v), 3)] for v in values]


def test_names_and_media_types(spark):
    names = ["a.txt", "A.PDF", "noext", ".hidden", ".hidden.html", "dot.", "a.tar.gz", "b.tgz", "c.html.gz",
             "d.q9", "e.svgz", "two words.Md", "f.JPEG", "..a", "g.xyz.bz2", "h.json"]
    assert evaluate(spark, names, mime.file_extension) == [
        PurePosixPath(n).suffix.lower().lstrip(".") for n in names
    ]
    # The standard table alone: the host may add types of its own to the process-wide one.
    table = mimetypes.MimeTypes(filenames=())
    guesses = [table.guess_type(n)[0] for n in names]
    assert evaluate(spark, names, mime.mime_from_name) == guesses
    typed = evaluate(spark, names, lambda v: mime.mime_type(v, F.lit(b"%PDF-1.4")))
    assert typed == [g or "application/pdf" for g in guesses]
    typed = evaluate(spark, names, lambda v: mime.mime_type(v, F.lit(b"PK")))
    assert typed == [g or "application/octet-stream" for g in guesses]
    assert evaluate(spark, ["file:/a/b c.pdf", "x"], mime.file_name) == ["b c.pdf", "x"]


def test_tokens_and_counts(spark):
    values = ["Él es. LA-la 42 naïve\u0301 straße", "", "the THE the a", "1234 --"]
    found = evaluate(spark, values, tokens.tokens)
    assert found == [["el", "es", "la", "la", "naive", "stra", "e"], [], ["the", "the", "the", "a"], []]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").withColumn("t", tokens.tokens(F.col("v")))
    counted = {r.i: dict(r.term_counts or []) for r in tokens.with_term_counts(rows, "t").collect()}
    assert counted == {i: dict(Counter(words)) for i, words in enumerate(found)}


def test_stop_words(spark):
    assert tokens.stop_word_list(spark, None) == []
    assert "the" in tokens.stop_word_list(spark, "english")
    found = evaluate(spark, ["the pump of it"], lambda v: tokens.remove_stop_words(tokens.tokens(v), ["the", "of"]))
    assert found == [["pump", "it"]]


@pytest.mark.parametrize(("stem", "words"), [
    ("consign", "consign consigned consigning consignment"),
    ("consist", "consist consisted consistency consistent consistently consisting consists"),
    ("consol", "consolation consolations console consoled consoles consoling"),
    ("consolatori", "consolatory"), ("consolid", "consolidate consolidated consolidating"),
    ("knack", "knack"), ("knackeri", "knackeries"), ("knave", "knaves knave"), ("knavish", "knavish"),
    ("knead", "kneaded kneading"), ("kneel", "kneel kneeled kneeling kneels"), ("knew", "knew"),
    ("knick", "knick"), ("knif", "knif"), ("knife", "knife"), ("knight", "knight knightly knights"),
    ("knit", "knit knits knitted knitting"), ("knive", "knives"), ("knob", "knob knobs"), ("knock", "knocked knocker"[:7]),
    ("valv", "valve valves"), ("hop", "hop hopped hopping"), ("hope", "hoped hoping hope"),
    ("generat", "generate generates generating generation"), ("generic", "generic generically"),
    ("communiti", "community communities"), ("arsenic", "arsenic"), ("sky", "skies sky"), ("die", "dying"),
    ("proceed", "proceed"), ("inning", "inning innings"), ("cri", "cry cries cried"), ("by", "by"), ("say", "say says"),
    ("tie", "ties tied"), ("gas", "gas"), ("this", "this"), ("gap", "gaps"), ("kiwi", "kiwis"), ("luxuri", "luxuriate luxury"),
    ("hydraul", "hydraulic hydraulics"), ("relief", "relief"), ("warranti", "warranty warranties"), ("agre", "agreed agree"),
    ("feed", "feed"), ("conform", "conformabli conformable"), ("radic", "radically"), ("vile", "vilely"),
    ("analog", "analogously"[:0] or "analogi"), ("callous", "callousness"), ("format", "formative"), ("adopt", "adoption"),
    ("hop", "hopping"), ("fall", "falling"), ("control", "controll"), ("roll", "roll"), ("probat", "probate"),
])
def test_stems(stem, words):
    assert {w: stem_english(w) for w in words.split()} == {w: stem for w in words.split()}


def test_stem_arrays(spark):
    values = [["valves", "valve", "the"], [], None, ["knightly"]]
    found = evaluate(spark, values, stem_arrays, "array<string>")
    assert found == [["valv", "valv", "the"], [], None, ["knight"]]
