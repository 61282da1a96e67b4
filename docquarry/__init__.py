"""Dated document corpora on Spark: assemble metadata, extract text, match, dedup, write, backfill."""

__version__ = "0.1.0"
