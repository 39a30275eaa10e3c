"""genoflux: sequence-record loading and curation as Spark DataFrame jobs.

Layout: ``functions`` (Column -> Column expressions), ``operators``
(DataFrame -> DataFrame transforms, joins, diffs, rules), ``sources``
(scans and sinks), ``plans`` (the cleaning chain, enrichment joins and the
user-level jobs), ``streaming`` (the feed stage over landed files).
"""

__version__ = "0.1.0"
