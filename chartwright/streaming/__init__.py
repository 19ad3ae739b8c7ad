"""Late-data handling.

The original job reads facts once a day and has no streams, windows or
state; "late data" is handled only by the load watermark (C1): a market's
chart is built for the newest day that all of its feeds have loaded.
No Structured Streaming query is built, on purpose (nothing to port).
"""

from chartwright.streaming.watermark import WatermarkError, load_watermark, resolve_watermark

__all__ = ["WatermarkError", "load_watermark", "resolve_watermark"]
