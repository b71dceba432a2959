"""Long-running state with Structured Streaming."""
