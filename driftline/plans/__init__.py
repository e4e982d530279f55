"""Plans: the batch ingest plan, the table sink, read-back helpers."""
