"""Incremental driving of the batch operators with Structured Streaming.

The reference has no streaming operator (real-time ingestion is out of its
scope).  The only piece here runs the batch-scoring operator (B1) over newly
arrived feature files with ``foreachBatch`` and an ``availableNow`` trigger,
so a periodic scoring job processes each new file exactly once (progress is
kept in a checkpoint under the shared checkpoint folder).
"""

from quarry.streaming.scoring import score_new_files  # noqa: F401
