"""Structured Streaming: the batch operators on streams, with checkpoints and progress tables."""
