"""Sources: driver tables, config-driven loader, items, generators, inventory."""
