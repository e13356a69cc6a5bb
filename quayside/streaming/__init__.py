"""The polling loops as Structured Streaming jobs."""
