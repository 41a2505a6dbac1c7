"""Reading the raw tables and lookups, writing snapshots and reports."""
