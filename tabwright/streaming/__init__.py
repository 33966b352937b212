"""Streaming forms of the reference's steps.

The reference has no streaming.  ``scoring.score_stream`` is the incremental form of its last
step: prepared scoring rows arriving as files are scored with a fitted pipeline and written as
submission rows, one idempotent partition per micro-batch.
"""
