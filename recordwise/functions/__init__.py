"""Column builders. Each function takes and returns Spark columns and never runs a job."""
