"""Streaming queries: start, run to the end, merge, split, and drop replays."""

from stratalake.streaming.merge import into_newest, start_merge
from stratalake.streaming.queries import run_to_end, start_append
from stratalake.streaming.replays import drop_replays_stream
from stratalake.streaming.split import into_batches, start_split

__all__ = [
    "drop_replays_stream", "into_batches", "into_newest", "run_to_end", "start_append",
    "start_merge", "start_split",
]
