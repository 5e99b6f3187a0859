"""terrarium: sensor-telemetry analytics on Spark.

Readings arrive as loosely structured JSON in an append-only log (or as
landed files); they are verified, enriched, cleaned with declarative rules,
turned into derived measures and rolled up over event-time windows, in batch
or as Structured Streaming queries.  Every step is a DataFrame transformation
built from Spark's own expressions, so Catalyst plans all of the data work.

Layout:
  functions/  Column expressions (time parsing, HMAC, calibration, ids)
  sources/    log scans, landed text/JSON payloads, the reading view
  operators/  cleaning rules, derived measures, rollups, as-of lookups,
              latest-per-key, enrichment, serving views, exports
  plans/      the dataset registry, named batch queries, join helpers
  streaming/  streaming rollups, keyed change logs, sinks, live tail
"""

from terrarium.session import ensure_utc, shared_dir

__all__ = ["ensure_utc", "shared_dir"]
