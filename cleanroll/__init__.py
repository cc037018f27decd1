"""Contact-data hygiene and enrichment as Spark dataflows."""
