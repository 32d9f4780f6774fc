"""Daily title snapshots, reader comments, topic keywords and review-based
recommendation, written as DataFrame-to-DataFrame functions for Spark."""

__version__ = "0.1.0"
