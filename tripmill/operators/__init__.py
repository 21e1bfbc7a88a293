"""DataFrame operators: cleaning, star schema, weather, quality, segments, geometry."""
