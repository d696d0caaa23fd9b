"""Incremental ingest of the raw log (see ``ingest``).

The reference has no streaming operators; its only recurring job is the
reload of the raw log when new rows arrive.  That is re-expressed here as a
Structured Streaming file source with an ``availableNow`` trigger.
"""
