"""daybook: model-ready 31-day sequence examples from sales tables, on Spark."""

__version__ = "0.1.0"
