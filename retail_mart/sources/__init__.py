"""Sources and sinks: raw-layer derivation, CSV ingestion, table writes."""
