"""Learning-analytics silver layer on Spark: ingest, staging, dimensional models, checks."""
