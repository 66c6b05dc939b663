"""Incremental landing. The reference is batch-only (no watermarks, windows or
state); the only streaming piece here is the raw landing step run over files as
they arrive, with the same rules as the batch landing."""

from lakestar.streaming.landing import land_stream  # noqa: F401
