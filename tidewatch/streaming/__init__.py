"""The incremental match as a Structured Streaming job."""
