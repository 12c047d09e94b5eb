"""Query catalogue: each analytic bound to the driver's tables, its DuckDB oracle, plan checks."""
