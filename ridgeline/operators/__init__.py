"""User-level DataFrame operators (one module per family)."""
