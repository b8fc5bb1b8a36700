"""Structured Streaming jobs: bronze, silver (foreachBatch), gold."""
