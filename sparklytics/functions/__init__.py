"""Column-level helpers (pure Catalyst expressions)."""
