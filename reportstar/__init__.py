"""Turn staged report grids into a checked star schema and analyse it, on Spark."""
