"""Daily market-bar analytics on Spark: ingest, quality, medallion layers, analytics."""
