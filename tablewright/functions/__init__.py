"""Column-level helpers: pure ``Column -> Column`` functions."""
