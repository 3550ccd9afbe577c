"""stratum.sources -- archive scan and member parsing, lake layout and sinks."""
