"""Spark-native lakehouse analytics: feeds, layers, contracts, KPIs, streams, scoring and forecasts."""
