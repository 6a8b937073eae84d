"""Emberscope: logs, traces and metrics analytics expressed as Spark plans."""

__version__ = "0.1.0"
