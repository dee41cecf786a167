"""Batch and streaming scans (A1-A10)."""

from lakeshelf.sources.files import (  # noqa: F401
    high_water_mark,
    ingest_stream,
    read_since,
    read_table,
    stream_table,
    with_lineage,
    with_source,
)
from lakeshelf.sources.messages import decode_messages, encode_messages, kafka_messages  # noqa: F401
