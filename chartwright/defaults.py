"""Parameter defaults.

Fixed values: these must equal the original job's values for equal results,
so they are stated here once, plainly, and used as keyword defaults.
"""

# --- fixed values -----------------------------------------------------------
TOP_N_SME = 5000                 # top ISRCs per market and day, feed SME
TOP_N_ORCHARD = 500              # same, feed ORCHARD
SHORT_VIDEO_TOP_SME = 250        # short-video top, feed SME
SHORT_VIDEO_TOP_ORCHARD = 50     # short-video top, feed ORCHARD
COVER_SOURCES = (487, 416)       # source types that count for the best cover
COVER_DAYS = 14                  # cover look-back in days
HOME_MARKET = "PL"               # covers are always taken from this market
PLAYLIST_LENGTH = 150
BATCH_SIZE = 100                 # URIs per publish call
DECLUMP_PASSES = 4               # range(1, 5)
CATALOGUE_AGE_DAYS = 56
VIRAL_CHART_DEPTH = 500          # chart rows that may pair with short-video rows
NAME_THRESHOLD = 0.9
ARTIST_THRESHOLD = 0.9
STOP_WORDS = ("of", "and", "or", "feat", "featuring", "ft", "the")
DESCRIPTION_PREFIX = "Dane na dzien "   # "data as of", followed by yyyy-MM-dd
BULK_LOAD_MAX_ERRORS = 2048
FEEDS = ("SME", "ORCHARD")       # feed priority: SME first

# Theme lists: name, segment thresholds, URI pattern, declump passes.
RAP_PATTERN = "rap|hip-hop"
GAMING_PATTERN = "rap|hip-hop|electro|edm"
PARTY_PATTERN = "electro|edm"
RAP_SHARE_MIN = 75.0             # rap > 75
GAMING_EDM_MIN = 25.0            # edm > 25
GAMING_RAP_MIN = 55.0            # or rap > 55 and edm > 1
GAMING_EDM_FLOOR = 1.0
PARTY_EDM_MIN = 20.0             # edm > 20
GAMING_PASSES = 0                # the scheduled job never declumps this list
# ---------------------------------------------------------------------------

# Plan settings (not from the original job).
TOP_K_BUCKETS = 16               # sub-groups of the two-level top-k per market
