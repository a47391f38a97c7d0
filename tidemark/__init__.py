"""Event-time market-data analytics on Spark: candles, marts, anomalies, quality checks."""
