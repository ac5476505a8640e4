"""Which pages need text recognition, running it, and merging its results."""

from __future__ import annotations

import contextlib
import heapq
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import is_nonblank

log = logging.getLogger(__name__)

OCR_TEXT = "document_id string, page_number int, ocr_text string, error string"


def needs_ocr() -> Column:
    """Blank text and at least one image."""
    return ~is_nonblank(F.col("page_text")) & (F.coalesce("image_count", F.lit(0)) > 0)


def ocr_candidates(pages: DataFrame) -> DataFrame:
    return pages.where(needs_ocr())


def run_ocr(
    candidates: DataFrame,
    engine: Callable[[dict], str],
    payload: list[str],
    partitions: int | None = None,
) -> DataFrame:
    """Recognise text page by page: (document_id, page_number, ocr_text, error).

    Pages, not files, are spread over the tasks, so one long scanned file keeps every core
    busy. ``payload`` names the columns the engine gets. A page that fails has empty text
    and its error; the other pages go on.
    """
    columns = list(dict.fromkeys(["document_id", "page_number", *payload]))
    wanted = partitions or candidates.sparkSession.sparkContext.defaultParallelism * 4

    def recognised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                found, error = "", None
                try:
                    found = engine({key: row[key] for key in payload}) or ""
                except Exception as exc:
                    error = f"{type(exc).__name__}: {exc}"
                    log.warning("page %s of %s: %s", row["page_number"], row["document_id"], error)
                out.append((row["document_id"], row["page_number"], found, error))
            ids, numbers, texts, errors = (list(values) for values in zip(*out)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(numbers, pa.int32()),
                 pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                names=["document_id", "page_number", "ocr_text", "error"],
            )

    return (
        candidates.select(*columns)
        .repartition(wanted, "document_id", "page_number")
        .mapInArrow(recognised, OCR_TEXT)
    )


@dataclass(frozen=True)
class FileEngine:
    """Recognition on an opened file: ``open(path)`` gives a document, a context manager if it needs closing,
    and ``recognise(document, page_number)`` the text of one of its pages."""

    open: Callable[[str], object]
    recognise: Callable[[object, int], str]


#: Units that a task gets about, where one file is large; the fewer, the fewer times it is opened.
UNITS_PER_TASK = 4


def _units(candidates: DataFrame, weight: Column, tasks: int) -> DataFrame:
    """Candidate pages with the ``task`` that recognises them: whole files, or page ranges of the large ones, packed by weight.

    A file above its share is cut into ranges of about that share. Ranges and files of half a share or
    more, of which there are few per task, go to the emptiest task, longest first. The many small
    files are dealt by hash.
    """
    pages = candidates.withColumn("_weight", F.greatest(F.coalesce(weight.cast("double"), F.lit(1.0)), F.lit(1e-9)))
    files = pages.groupBy("document_id").agg(
        F.sum("_weight").alias("_all"), F.min("page_number").alias("_first"), F.max("page_number").alias("_last")
    )
    share = (files.agg(F.sum("_all")).first()[0] or 1.0) / (tasks * UNITS_PER_TASK)
    parts = F.ceil(F.col("_all") / share)
    within = (F.col("page_number") - F.col("_first")) / (F.col("_last") - F.col("_first") + 1)
    cut = pages.join(files, "document_id").withColumn("_part", F.floor(within * parts).cast("int")).drop("_first", "_last", "_all")
    units = cut.groupBy("document_id", "_part").agg(F.sum("_weight").alias("_of_unit"))
    large = units.where(F.col("_of_unit") >= share / 2).collect()  # two for each share at most
    loads, placed = [(0.0, task) for task in range(tasks)], []
    for row in sorted(large, key=lambda r: (-r["_of_unit"], r["document_id"], r["_part"])):
        load, task = heapq.heappop(loads)
        placed.append((row["document_id"], row["_part"], task))
        heapq.heappush(loads, (load + row["_of_unit"], task))
    known = candidates.sparkSession.createDataFrame(placed, "document_id string, _part int, _task int")
    dealt = F.pmod(F.xxhash64("document_id", "_part"), F.lit(tasks)).cast("int")
    return cut.join(known, ["document_id", "_part"], "left").withColumn("task", F.coalesce("_task", dealt)).drop("_part", "_task", "_weight")


def run_ocr_files(
    candidates: DataFrame, engine: FileEngine, path: str = "file_path", weight: Column | None = None, tasks: int | None = None
) -> DataFrame:
    """Recognise pages of files that are opened once for a run of pages: (document_id, page_number, ocr_text, error).

    ``weight`` is what a page costs, such as its share of the file's bytes; 1 if not given. A page that
    fails has empty text and its error, and so have all wanted pages of a file that cannot be opened.
    """
    tasks = tasks or candidates.sparkSession.sparkContext.defaultParallelism * 4

    def recognised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = document = broken = None
        with contextlib.ExitStack() as held:
            for batch in batches:
                ids, numbers, paths = (batch.column(i).to_pylist() for i in range(3))
                texts, errors = [], []
                for number, file in zip(numbers, paths, strict=True):
                    found, error = "", None
                    try:
                        if file != name:
                            held.close()
                            name, document, broken = file, None, None
                            document = engine.open(file)
                            if hasattr(document, "__exit__"):
                                document = held.enter_context(document)
                        if broken is None:
                            found = engine.recognise(document, number) or ""
                    except Exception as exc:
                        error = f"{type(exc).__name__}: {exc}"
                        log.warning("page %s of %s: %s", number, file, error)
                        if document is None:
                            broken = error
                    texts.append(found)
                    errors.append(error or broken)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(numbers, pa.int32()), pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                    names=["document_id", "page_number", "ocr_text", "error"],
                )

    wanted = candidates.select("document_id", "page_number", F.col(path).alias("_path"), (F.lit(1) if weight is None else weight).alias("_cost"))
    placed = _units(wanted, F.col("_cost"), tasks).repartitionById(tasks, "task").sortWithinPartitions("_path", "page_number")
    return placed.select("document_id", "page_number", "_path").mapInArrow(recognised, OCR_TEXT)


def merge_ocr(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """Put recognised text on the candidate pages where it is not blank.

    Only candidates are joined. They are blank, so the join moves no page text; all other
    pages pass by unshuffled.
    """
    found = recognised.select("document_id", "page_number", "ocr_text")
    joined = ocr_candidates(pages).join(found, ["document_id", "page_number"], "left")
    usable = is_nonblank(F.col("ocr_text"))
    merged = joined.withColumns({
        "page_text": F.when(usable, F.col("ocr_text")).otherwise(F.col("page_text")),
        "extraction_method": F.when(usable, "ocr").otherwise(F.col("extraction_method")),
    }).withColumn("char_count", F.char_length("page_text")).select(*pages.columns)
    return pages.where(~needs_ocr()).unionByName(merged)
