"""Event-time commit analytics (C0-C9) and a replay runner for Structured Streaming."""
