"""Structured Streaming form of the quality-history append."""

from cartwheel.streaming.monitor import start_quality_monitor  # noqa: F401
