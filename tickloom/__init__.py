"""Exchange-trade analytics on Spark: ingest, dedup, candles, refresh, publish, dashboards."""
