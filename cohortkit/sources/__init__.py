"""Readers (delimited extracts, driver tables) and sinks."""

from .delimited import read_delimited, file_encodings, read_sources
from .publish import clear_unpublished, publish, read_published
from .sinks import write_table, quarantine

__all__ = ["read_delimited", "file_encodings", "read_sources", "write_table", "quarantine",
           "publish", "read_published", "clear_unpublished"]
