"""Table specifications, source contracts, raw sheet grids, and sinks."""
