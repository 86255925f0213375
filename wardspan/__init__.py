"""Clinical records on Spark: source tables in, common data model tables and eras out."""
