"""refsync: keep a wide reference table in sync with dropped files, and work with it, on Spark."""

__version__ = "0.1.0"
