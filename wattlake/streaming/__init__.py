"""The same jobs as Structured Streaming queries."""
