"""Research-metadata harvest and curation as Spark jobs."""
