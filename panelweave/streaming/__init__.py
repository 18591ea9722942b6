"""Incremental accumulation over streams of panel blocks."""

from .accumulate import MarkerAccumulator, stream_marker_stats

__all__ = ["MarkerAccumulator", "stream_marker_stats"]
