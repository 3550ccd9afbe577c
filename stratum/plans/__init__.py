"""stratum.plans -- the pipeline, the test-table adapters and the query catalogue."""
