"""Readers: commit JSON, driver-table stand-ins (commit views, logs, book, lists), file listing."""
