"""Readers: manifest, crawl archives, page tables, message streams."""

from pagevane.sources.manifest import read_manifest
from pagevane.sources.messages import message_stream, read_messages
from pagevane.sources.pages import read_pages, spread
from pagevane.sources.warc import WarcDataSource, read_archives, register

__all__ = [
    "WarcDataSource",
    "message_stream",
    "read_archives",
    "read_manifest",
    "read_messages",
    "read_pages",
    "register",
    "spread",
]
