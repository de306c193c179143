from tierflow.streaming.ingest import ingest_stream, refresh_batch
from tierflow.streaming.versions import ingest_versions

__all__ = ["ingest_stream", "ingest_versions", "refresh_batch"]
