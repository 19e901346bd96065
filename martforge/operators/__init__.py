"""Layer transforms: detail, summaries, marts, quality checks, chart datasets."""
