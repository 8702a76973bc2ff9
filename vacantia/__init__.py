"""Vacantia: job-posting analytics as Spark jobs (ingest, star schema, marts, skills, salaries, matching)."""
