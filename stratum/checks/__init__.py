"""Registered checks (Spark query + DuckDB oracle SQL per inventory item)."""
