"""martforge - a layered retail warehouse built from Spark DataFrame jobs.

raw tables -> trade detail -> daily / per-customer summaries -> reporting
marts, plus data-quality checks, chart datasets and CSV export.
"""

__version__ = "0.1.0"
