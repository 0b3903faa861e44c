"""Log analytics on Spark: structure, mine, report, stream and classify log lines."""

__version__ = "0.1.0"
