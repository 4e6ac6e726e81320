"""waitcast — queue-time analytics expressed as Spark DataFrame plans.

Layout:
    sources/    scans, mappings of the driver tables, sinks, artifacts
    functions/  column expressions (hour parsing, calendar, labels, fills)
    operators/  DataFrame -> DataFrame operators (clean, dedup, histories, joins,
                cascade, blend, encodings, metrics, models)
    plans/      composed jobs (feature layer, training, batch scoring, query catalog)
    streaming/  Structured Streaming ingestion and incremental merge
"""

__all__ = ["session", "schema"]
