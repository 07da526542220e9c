"""Sources: table scans, landed payloads and ingest shaping."""
