"""Content identity: hashes, deterministic ids, page keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of the name-based (version 5) document ids.
DOCUMENT_ID_NAMESPACE = "2d0f9a3e-7c4b-4d6e-9f11-5b3f0c1a2e77"


def sha256_hex(content: Column) -> Column:
    return F.sha2(content, 256)


def document_id(sha256: Column) -> Column:
    """RFC 4122 version-5 UUID of the hash text; equal bytes always get the equal id."""
    namespace = F.unhex(F.lit(DOCUMENT_ID_NAMESPACE.replace("-", "")))
    digest = F.sha1(F.concat(namespace, F.encode(sha256, "UTF-8")))
    # The variant digit keeps its two low bits under a leading binary 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    dash = F.lit("-")
    return F.concat(
        F.substring(digest, 1, 8), dash,
        F.substring(digest, 9, 4), dash,
        F.lit("5"), F.substring(digest, 14, 3), dash,
        variant, F.substring(digest, 18, 3), dash,
        F.substring(digest, 21, 12),
    )


def page_id(document: Column, page_number: Column) -> Column:
    return F.concat(document, F.lit(":"), page_number.cast("string"))


def document_key(document: Column) -> Column:
    """The 16 bytes of an id: less than half its text, in the same order."""
    return F.unhex(F.replace(document, F.lit("-")))


def document_of_key(key: Column) -> Column:
    text = F.lower(F.hex(key))
    return F.concat_ws("-", *[F.substring(text, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
