"""Name-based file attributes: last path part, extension, media type."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five-byte file mark and the two fall-back media types.
PDF_MARK = b"%PDF-"
PDF_TYPE = "application/pdf"
UNKNOWN_TYPE = "application/octet-stream"

# Python's own table, apart from the process-wide one that other code may extend.
_STANDARD = mimetypes.MimeTypes(filenames=())


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def suffix(name: Column) -> Column:
    """Last suffix without its dot; '' when the name has none, starts or ends with its only dot."""
    return F.regexp_extract(name, r"(?s)^.+\.([^.]+)$", 1)


def file_extension(name: Column) -> Column:
    return F.lower(suffix(name))


def _ending(name: Column) -> Column:
    """Last suffix as media types see it: dots at the start of a name do not count."""
    return F.lower(F.regexp_extract(name, r"(?s)[^.].*\.([^.]+)$", 1))


def _lookup(table: dict[str, str], key: Column) -> Column:
    literals = ", ".join(f"'{part}'" for pair in sorted(table.items()) for part in pair)
    return F.try_element_at(F.expr(f"map({literals})"), key)


def mime_from_name(name: Column) -> Column:
    """Media type by extension from Python's standard table (a constant-size map literal).

    Short compressed forms (``.tgz``) are spelled out first, then a compression suffix is
    set aside and the suffix before it decides. NULL when the extension is not known.
    """
    types = {ext.lstrip("."): kind for ext, kind in _STANDARD.types_map[True].items()}
    short = {ext.lstrip("."): full for ext, full in _STANDARD.suffix_map.items()}
    packed = "|".join(sorted(ext.lstrip(".") for ext in _STANDARD.encodings_map))

    stem = F.regexp_replace(name, r"\.[^.]+$", "")
    spelled = F.coalesce(F.concat(stem, _lookup(short, _ending(name))), name)
    plain = F.regexp_replace(spelled, rf"(?<=[^.])\.({packed})$", "")
    return _lookup(types, _ending(plain))


def mime_type(name: Column, head: Column) -> Column:
    """Extension first; else the file mark in the first bytes; else the unknown type."""
    marked = F.when(F.substring(head, 1, len(PDF_MARK)) == F.lit(PDF_MARK), PDF_TYPE)
    return F.coalesce(mime_from_name(name), marked, F.lit(UNKNOWN_TYPE))
