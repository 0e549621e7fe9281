"""Streaming: the reference pipeline is daily batch only; see ``incremental``."""
