"""Scans (``readers``) and sinks (``writers``)."""
