"""Readers: event envelopes, log tables, billing exports and stored results."""
