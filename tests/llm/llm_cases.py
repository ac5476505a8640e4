"""Small tables that hold the awkward cases: nulls, blanks, long texts, repeated rows, clashing names."""

import duckdb
import pandas as pd

TABLES = "documents embeddings benchmark labels conversations".split()


def frame(spark, texts, extra=""):
    """(doc_id, text) rows with the other columns of documents; ``extra`` adds columns whose names clash."""
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.selectExpr("doc_id", "text", "'en' AS lang", "'src' AS source", "length(text) AS n_chars", *filter(None, [extra]))


def awkward(spark, schema="doc_id long, text string"):
    rows = [(1, None), (2, ""), (3, " \n\t "), (3, " \n\t "), (None, "null id here"), (4, "¿ñ? 漢字 🙂 …"), (5, "x" * 50_000), (6, "a b " * 20_000), (6, "a b " * 20_000)]
    return spark.createDataFrame(rows, schema)


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def same(spark_frame, expected: pd.DataFrame):
    """Equal as sets of rows, columns by name."""
    columns = sorted(spark_frame.columns)
    assert columns == sorted(expected.columns)
    found = sorted(map(repr, (tuple(row[c] for c in columns) for row in spark_frame.collect())))
    wanted = sorted(repr(tuple(x.item() if hasattr(x, "item") else x for x in row)) for row in expected[columns].itertuples(index=False))
    assert len(found) == len(wanted)
    different = [(a, b) for a, b in zip(found, wanted, strict=True) if a != b]
    assert not different, f"{len(different)} differ, first {different[0]}"
