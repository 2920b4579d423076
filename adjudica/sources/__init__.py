"""Table readers, schema conforming, logs, artifacts and worklists."""
