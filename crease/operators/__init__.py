"""DataFrame -> DataFrame operators: dedup, ranking, Silver, Gold, reports."""
