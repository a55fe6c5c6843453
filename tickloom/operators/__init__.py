"""DataFrame operators: cleansing, enrichment, quality, skew and reports."""
