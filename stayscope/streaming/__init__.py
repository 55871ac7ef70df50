"""Scoring of arriving texts."""

from stayscope.streaming.scoring import negative_alerts, score_stream

__all__ = ["negative_alerts", "score_stream"]
