"""Multi-layer jobs (replay / backfill) and the registered query catalog."""
