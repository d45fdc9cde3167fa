"""Keyed document logs on Spark: ingest, current-version tables, offsets, lag and audits."""

from docstream.config import IngestConfig
from docstream.streaming.control import Ingest

__all__ = ["Ingest", "IngestConfig"]
