"""stratum.functions -- native Column expressions for cleaning, parsing and keys."""
