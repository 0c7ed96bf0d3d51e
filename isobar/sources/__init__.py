"""Sources and sinks: table readers, fixtures derived from them, stores."""
