"""padron: workforce data pipelines as Spark DataFrame jobs."""
