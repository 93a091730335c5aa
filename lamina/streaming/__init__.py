"""Structured Streaming: bounded incremental append copies with lineage and
exactly-once restarts through the checkpoint."""
