"""Structured Streaming: event enrichment, Silver append and churn alerts."""
