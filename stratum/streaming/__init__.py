"""Structured Streaming twins of the batch operators.

Every runner writes only under the shared checkpoint folder and is
restartable from its checkpoint; re-running a completed micro-batch id
rewrites the same output (idempotent sinks)."""
