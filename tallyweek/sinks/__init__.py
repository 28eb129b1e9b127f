"""Writing reports per season, and landing intermediate tables in the shared folder."""
