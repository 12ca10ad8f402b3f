from marquee.streaming.ingest import (
    EventHistorySink,
    RegistryDedupSink,
    SnapshotSink,
    dedup_exact,
    dedup_stream,
    ingest_stream,
    run_available,
    run_to_files,
)

__all__ = ["EventHistorySink", "RegistryDedupSink", "SnapshotSink", "dedup_exact", "dedup_stream", "ingest_stream", "run_available",
           "run_to_files"]
