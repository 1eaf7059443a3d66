"""briefwright: Spark jobs that turn landed feeds into clean items, ranked events and reports."""

__version__ = "0.1.0"
