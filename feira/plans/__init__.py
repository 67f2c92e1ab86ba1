"""The jobs: ingest, clean tables, marts, and the full refresh."""
