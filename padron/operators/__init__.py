"""DataFrame operators: row cuts, shaping, joins, aggregates, catalogues, quality checks."""
