"""The sync as a Structured Streaming job over dropped files."""
