"""Sources and sinks: raw landing readers, test fixtures derived from the driver tables, writers."""
