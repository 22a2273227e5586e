"""Sources and sinks: the driver tables and JSON-lines files."""
