"""A document and page store with text search, on Spark."""

from importlib import import_module

__version__ = "0.1.0"

_EXPORTS = {
    "PageStore": "quire.plans.store",
    "LoadOptions": "quire.plans.load",
    "load_files": "quire.plans.load",
    "load_and_index": "quire.plans.load",
    "dry_run": "quire.plans.load",
    "scan_files": "quire.sources.files",
    "inspect_files": "quire.sources.files",
    "extract_pages": "quire.sources.extract",
    "Plugin": "quire.sources.extract",
    "PageRange": "quire.sources.extract",
    "TEXT": "quire.sources.extract",
    "HTML": "quire.sources.extract",
    "ingest": "quire.streaming.ingest",
    "stream_files": "quire.streaming.ingest",
    "SearchIndex": "quire.operators.ranking",
}
__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    """Exports load on use, so that a worker importing one plug-in does not import everything."""
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
