"""Chart, short-video and playlist operators (DataFrame -> DataFrame)."""
