"""The scheduled jobs as Structured Streaming queries."""
