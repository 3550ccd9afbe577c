"""stratum.operators -- silver, quality, validate, dims, facts, marts, publish."""
