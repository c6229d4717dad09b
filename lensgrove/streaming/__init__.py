"""Streams: pages as they come, and ledgers that grow."""
