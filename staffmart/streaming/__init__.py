from staffmart.streaming.incremental import ENTITIES, ingest

__all__ = ["ENTITIES", "ingest"]
