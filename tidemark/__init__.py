"""Layered analytics tables on Spark: ingest, change capture, star schema, metrics.

Every public function takes and returns DataFrames (or Columns) and leaves the
physical plan to Catalyst; none of them keeps a session of its own.
"""
