"""Structured Streaming use of the row-level operators.

The study is batch-only; every row-level operator (filters, derived columns,
flags) is a stateless projection/filter and runs unchanged on a streaming
DataFrame.  This package wires them to a file stream with a checkpoint in the
shared folder, and keeps per-category event counts (the SWOE/WOE fit input)
up to date with ``foreachBatch``."""
