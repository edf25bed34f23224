"""Card-transaction features, scoring and monitoring as Spark jobs."""
