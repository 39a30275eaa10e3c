"""The cleaning chain, enrichment joins and user-level jobs."""
