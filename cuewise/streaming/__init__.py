"""Transcripts as streams: new documents in a folder are routed as they come."""
