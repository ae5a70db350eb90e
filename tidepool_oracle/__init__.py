"""DuckDB oracle SQL for every registered query (written independently of the
Spark plans, in the reference's window shape)."""
