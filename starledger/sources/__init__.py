"""Sources and sinks: CSV scan, fixture tables, snapshot, export, publish."""
