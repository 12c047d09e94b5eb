"""sparklytics: analytics over nested commit records, logs, text and lists,
written as plain PySpark DataFrame functions (Catalyst expressions, no Python UDFs)."""

__version__ = "0.1.0"
