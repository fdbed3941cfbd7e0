"""Structured Streaming: message source and sink, and the strike stream."""
