"""Spark operators for collections of short, sectioned text reports."""

__version__ = "0.1.0"
