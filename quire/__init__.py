"""quire: review marts, serving lookups and event-stream jobs on Spark."""

__version__ = "0.1.0"
