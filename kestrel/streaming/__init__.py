"""Streaming.

The workloads this library reproduces are batch jobs; none of them reads a
stream, keeps state between micro-batches or uses watermarks.  Every
operator here is a plain DataFrame transformation, so the stateless ones
(parsing, projections, filters) apply unchanged to a ``readStream``
DataFrame; nothing stream-specific is provided.
"""
