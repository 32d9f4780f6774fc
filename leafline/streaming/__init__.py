"""The daily jobs as incremental Structured Streaming runs."""
