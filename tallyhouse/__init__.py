"""Tallyhouse: Spark-native analytics for organisations with several campuses.

Layers: ``sources`` (bronze scans and table maintenance), ``operators`` (silver
staging, gold dimensions, facts, marts and report metrics), ``functions``
(column helpers), ``streaming`` (incremental upserts) and ``plans`` (the
registered queries over the driver tables, each with its SQL check).
"""
