"""Scans: Bronze envelopes, raw captures, Silver tables, fixture views."""
