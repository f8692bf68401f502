"""qalake: Q&A community dump ingestion and analytics on Spark.

Subpackages: ``sources`` (dump scan, file listing, piece hashes), ``functions``
(column helpers), ``operators`` (post_tags, staging, tables), ``plans`` (the
analytics), ``streaming`` (incremental ingest). ``pipeline`` runs dump ->
tables; ``registry`` and ``registry_ingest`` list the checked queries.
"""

__version__ = "0.1.0"
