"""boardloom: notice-board analytics and corpus preparation as declarative Spark plans."""

__version__ = "0.1.0"
