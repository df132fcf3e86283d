"""Content analytics on Spark: ingestion, versioned content tables, note derivation and quality views."""
