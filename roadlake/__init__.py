"""roadlake: ingest, enrich and upsert vehicle events with plain PySpark."""
