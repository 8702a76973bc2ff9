"""Reading and writing: landed JSON envelopes, job pages, Parquet tables."""
