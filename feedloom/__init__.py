"""feedloom: content-feed analytics on PySpark (ingest, dedup, selection, digest, reporting)."""

__version__ = "0.1.0"
