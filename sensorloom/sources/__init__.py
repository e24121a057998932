"""Event logs, JSON folders and the sinks."""
