"""Sources and sinks: raw file reads, fixture builders, warehouse storage."""
