"""The pipeline stages as Structured Streaming jobs."""

from pagevane.streaming.jobs import (
    drop_replays,
    extract_job,
    fused_job,
    index_job,
    metrics_job,
    rollup_job,
    vectorize_job,
)
from pagevane.streaming.queues import json_queue, manifest_queue, page_queue, stage_queue

__all__ = [
    "drop_replays",
    "extract_job",
    "fused_job",
    "index_job",
    "json_queue",
    "manifest_queue",
    "metrics_job",
    "page_queue",
    "rollup_job",
    "stage_queue",
    "vectorize_job",
]
