"""The same cleaning and sessions on Structured Streaming."""
