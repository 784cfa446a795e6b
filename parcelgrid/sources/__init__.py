"""Sources: conformed-table IO, CSV feeds, JSON payloads, file listings."""
