"""Plans: skew-proof ordered scans, model build, pipeline and query catalogue."""
