"""Structured Streaming: daily yield KPIs over an event-time watermark."""
