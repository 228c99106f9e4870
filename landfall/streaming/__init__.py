from .upsert_stream import upsert_available, upsert_stream

__all__ = ["upsert_available", "upsert_stream"]
