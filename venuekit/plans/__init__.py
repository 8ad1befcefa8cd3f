"""Data products: clean tables, reports, sentiment, topics, recommendations."""
