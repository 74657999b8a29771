"""Daily-balance warehouse on Spark: ingest, star schema, balance fact, checks and sinks."""
