"""Usage observability on PySpark: ingest, curate, view, measure."""
