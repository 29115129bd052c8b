"""The daily increment as Structured Streaming."""
