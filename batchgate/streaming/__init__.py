from batchgate.streaming.incoming import stream_incoming, stream_versions

__all__ = ["stream_incoming", "stream_versions"]
