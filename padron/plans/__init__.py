"""One Spark job per domain flow: raw sheet grids to clean tables to typed, enriched and versioned tables."""
