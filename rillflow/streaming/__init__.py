"""Structured Streaming: running queries to a sink, and stateful processors for what
the built-in stateful operators cannot say."""

from rillflow.streaming.runner import StreamRun, run_stream

__all__ = ["StreamRun", "run_stream"]
