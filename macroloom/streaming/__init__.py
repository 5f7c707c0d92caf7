from macroloom.streaming import ingest

__all__ = ["ingest"]
