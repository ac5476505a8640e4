"""Times the headline jobs and queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from quire.plans import queries
from quire.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP_DIR = str(Path(SF_DIR).parent / "sf0.001")

QUERIES = (
    "content_hash", "document_ids", "pdf_date_parse", "extract_pages", "html_pages", "ocr_merge",
    "chunk_content", "chunk_verify", "chunk_gaps", "load_dedup", "document_rollup", "document_text",
    "search_substring", "search_wildcard", "tokenize_pages", "index_postings", "search_ranked",
    "search_ranked_all_terms", "search_ranked_stemmed", "search_ranked_batch", "index_staleness",
)


def run(spark, sf_dir: str) -> dict[str, float]:
    """Seconds per step: the load with its index first, then the queries on the loaded store."""
    seconds = {}
    steps = {
        "load": lambda: queries.loaded_store(spark, sf_dir),
        "index": lambda: queries.indexed_store(spark, sf_dir),
        "stemmed_index": lambda: queries.stemmed_store(spark, sf_dir),
        "load_index_delete": lambda: queries.reduced_store(spark, sf_dir),
        "stream_ingest": lambda: queries.streamed_store(spark, sf_dir),
    }
    for name, step in steps.items():
        started = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - started, 3)
    registered = queries.registered()
    for name in QUERIES:
        started = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    return seconds


def main() -> None:
    spark = local_session("quire-bench", CPUS, **{"spark.sql.shuffle.partitions": CPUS, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    with contextlib.redirect_stdout(sys.stderr):
        if Path(WARM_UP_DIR).is_dir() and WARM_UP_DIR != SF_DIR:
            run(spark, WARM_UP_DIR)
        seconds = run(spark, SF_DIR)
        store = queries.loaded_store(spark, SF_DIR)
        pages, size = store.pages().count(), store.documents().selectExpr("sum(file_size_bytes)").first()[0]
    load = seconds["load"] + seconds["index"]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"), "pages": pages, "bytes": size,
        "pages_per_sec_loaded_and_indexed": round(pages / load, 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
