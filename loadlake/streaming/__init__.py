"""Intraday features and forecasts on Structured Streaming."""
