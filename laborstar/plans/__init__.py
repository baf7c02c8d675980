"""Query plans: reports over the star schema, the ETL pipeline, the registry."""
