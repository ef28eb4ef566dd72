"""Structured Streaming forms of the Bronze, Silver, Gold and feature jobs."""
