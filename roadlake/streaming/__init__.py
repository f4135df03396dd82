"""The three continuous jobs: ingest, enrich, load."""
