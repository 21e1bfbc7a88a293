"""Readers and writers: trip Parquet, weather and zone CSV, zone GeoJSON, warehouse tables."""
