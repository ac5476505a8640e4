"""The three stored tables. Fixed, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(spec: str) -> T.StructType:
    """``name type`` per line; a trailing ``!`` marks a required column."""
    kinds = {
        "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(),
        "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
        "binary": T.BinaryType(), "strings": T.ArrayType(T.StringType()),
    }
    fields = []
    for line in spec.split("\n"):
        if line.strip():
            name, kind = line.split()
            fields.append(T.StructField(name, kinds[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


DOCUMENTS = _fields("""
    document_id string!
    file_name string!
    file_path string
    file_extension string
    mime_type string!
    file_size_bytes long!
    sha256_hex string!
    file_modified_at timestamp
    page_count int
    pdf_format string
    title string
    author string
    subject string
    keywords string
    creator string
    producer string
    pdf_created_at timestamp
    pdf_modified_at timestamp
    is_encrypted boolean
    encryption_method string
    needs_password boolean
    layer_names strings
    hidden_layer_names strings
    hidden_layers_revealed boolean
    chunk_size_bytes int!
    chunk_count int!
    pages_with_text int
    pages_ocr int
    total_text_chars long
    loaded_at timestamp!
    loaded_by string
    loader_version string
""")

CHUNKS = _fields("""
    document_id string!
    chunk_index int!
    byte_offset long!
    chunk_length_bytes int!
    content binary!
""")

PAGES = _fields("""
    document_id string!
    page_number int!
    page_id string!
    page_label string
    width_pt double
    height_pt double
    rotation int
    image_count int
    extraction_method string
    char_count int
    page_text string
""")

# What a file-inspection plug-in reports about one file (raw strings; see sources.inspect).
FILE_INFO = _fields("""
    page_count int
    pdf_format string
    title string
    author string
    subject string
    keywords string
    creator string
    producer string
    created_raw string
    modified_raw string
    encryption_method string
    needs_password boolean
    layer_names strings
    hidden_layer_names strings
""")


def required(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]
