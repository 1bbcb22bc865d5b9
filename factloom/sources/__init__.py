"""Reading sources, publishing snapshots, and the catalogue."""
