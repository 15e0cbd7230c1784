"""Structured Streaming feed of the intraday export."""
