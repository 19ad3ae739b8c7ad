"""chartwright: daily music charts and playlists as Spark DataFrame jobs."""

__version__ = "0.1.0"
