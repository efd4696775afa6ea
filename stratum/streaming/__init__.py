"""Structured Streaming form of the landing step."""

from stratum.streaming.landing import land_new_drops

__all__ = ["land_new_drops"]
