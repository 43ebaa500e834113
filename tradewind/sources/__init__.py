"""Raw feeds, and the Parquet tables the job reads and writes."""
