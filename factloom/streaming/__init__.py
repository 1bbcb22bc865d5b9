"""Delta loads driven by Structured Streaming."""
