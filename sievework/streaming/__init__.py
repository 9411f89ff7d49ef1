"""Incremental runs, cumulative checkpoints, job progress and metrics as Structured Streaming."""
