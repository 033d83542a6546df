"""Schemas, keys and fixed labels of the catalog model."""

from __future__ import annotations

from pyspark.sql import types as T

SNAPSHOT = "snapshot_date"
#: Rows that stand for several snapshots: a bit per snapshot, and the value by which all rows of a key are dealt.
SEEN, DEALT = "__seen", "__dealt"
ENTITIES = ("artists", "albums", "tracks")

# Keys, rules, bounds and schemas that the data model prescribes.
ENTITY_KEY = {"artists": "artist_id", "albums": "album_id", "tracks": "track_id"}

CRITICAL_COLUMNS = {
    "artists": ("artist_id", "artist_name"),
    "albums": ("album_id", "album_name", "artist_id"),
    "tracks": ("track_id", "track_name", "album_id", "artist_id"),
}

# (child, parent, key): the key has the same name on both sides.
FOREIGN_KEYS = (
    ("albums", "artists", "artist_id"),
    ("tracks", "albums", "album_id"),
    ("tracks", "artists", "artist_id"),
)

# Inclusive bounds, None = open side.
TRACK_BOUNDS = {
    "duration_ms": (1, 7_200_000),
    "track_number": (1, None),
    "disc_number": (1, None),
}

MAX_ORPHAN_PCT = 5.0

RAW_SCHEMAS = {
    "artists": T.StructType([
        T.StructField("artist_id", T.StringType(), False),
        T.StructField("artist_name", T.StringType(), False),
        T.StructField("external_uri", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("snapshot_date", T.StringType(), False),
    ]),
    "albums": T.StructType([
        T.StructField("album_id", T.StringType(), False),
        T.StructField("album_name", T.StringType(), False),
        T.StructField("album_type", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("release_date_precision", T.StringType()),
        T.StructField("total_tracks", T.IntegerType()),
        T.StructField("artist_id", T.StringType(), False),
        T.StructField("artist_name", T.StringType()),
        T.StructField("external_uri", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("snapshot_date", T.StringType(), False),
    ]),
    "tracks": T.StructType([
        T.StructField("track_id", T.StringType(), False),
        T.StructField("track_name", T.StringType(), False),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("explicit", T.BooleanType()),
        T.StructField("track_number", T.IntegerType()),
        T.StructField("disc_number", T.IntegerType()),
        T.StructField("album_id", T.StringType(), False),
        T.StructField("artist_id", T.StringType(), False),
        T.StructField("external_uri", T.StringType()),
        T.StructField("extracted_at", T.StringType()),
        T.StructField("snapshot_date", T.StringType(), False),
    ]),
}


def raw_schema(entity: str) -> T.StructType:
    """Declared schema of one raw entity; unknown entities are an error."""
    if entity not in RAW_SCHEMAS:
        raise ValueError(f"unknown entity {entity!r}, expected one of {ENTITIES}")
    return RAW_SCHEMAS[entity]


# --- Fixed values -----------------------------------------------------------
# Labels and cut-offs below are part of the results: downstream users filter on
# them, so they are stated literally.

# Composite index: weights of the recent / growth / cadence scores.
WEIGHT_RECENT, WEIGHT_GROWTH, WEIGHT_CADENCE = 0.40, 0.35, 0.25
POINTS_PER_RELEASE = 10.0
GROWTH_NEUTRAL, GROWTH_SLOPE = 50.0, 5.0
CADENCE_NEUTRAL, CADENCE_FLOOR = 50.0, 10.0
CADENCE_BEST_DAYS, CADENCE_WORST_DAYS, CADENCE_SPAN = 14.0, 180.0, 90.0
RECENT_WINDOW_DAYS = 365

# (inclusive lower bound, label); the last label is the "else" branch.
MOMENTUM_TIERS = (
    (75.0, "Elite Velocity (Top Tier)"),
    (60.0, "High Momentum (Active Campaign)"),
    (45.0, "Moderate Momentum (Steady Catalog)"),
    (None, "Low Momentum / Dormant (Hiatus)"),
)
MOMENTUM_BADGES = (
    (75.0, "🔥 Hyper-Paced"),
    (50.0, "⚡ High Velocity"),
    (25.0, "📈 Steady Expansion"),
    (None, "⏳ Dormant / Archival"),
)
MOMENTUM_BADGE_NULL = "⚪ Unranked"
ACTIVITY_TIERS = (
    (10, "Hyper-Active (10+ drops/yr)"),
    (5, "Active Campaign (5-9 drops/yr)"),
    (1, "Moderate Maintenance (1-4 drops/yr)"),
    (None, "Dormant / Hiatus (0 drops/yr)"),
)
STRATEGY_BY_RATIO = (
    (5.0, "Single-Dominant (Streaming-First)"),
    (2.0, "Balanced Hybrid"),
    (None, "Album-Focused (Traditional)"),
)
STRATEGY_BY_SHARE = (
    (80.0, "Single-Dominant (Streaming-First)"),
    (60.0, "Balanced Hybrid"),
    (None, "Album-Centric (Traditional)"),
)
GROWTH_BASELINE = "Baseline Snapshot (Initial)"
GROWTH_EXPANSION = "Catalog Expansion (Active Growth)"
GROWTH_STATIC = "Static Catalog (Zero Change)"
GROWTH_REDUCTION = "Catalog Reduction (Delisting)"
GROWTH_PRUNING = "Catalog Pruning / Retractions"
TRAJECTORY_INITIAL = "Initial Observation"
TRAJECTORY_UP = "Surging (+)"
TRAJECTORY_DOWN = "Decelerating (-)"
TRAJECTORY_FLAT = "Stable (0.0)"
SEASON_ARCHETYPES = (
    ((6, 7), "Summer Single Surge (Streaming Peak)"),
    ((10, 11), "Q4 Holiday & Grammy Window (LP Heavy)"),
    ((5,), "Late Spring Festival Pre-Release"),
    ((1, 2), "Q1 Industry Cooldown & Singles Reset"),
    (None, "Mid-Season Catalog Drops"),
)
DATE_SENTINELS = ("", "N/A", "null")
COUNT_SENTINELS = ("", "null")
MISSING_TEXT = "—"
# --- End of fixed values ----------------------------------------------------

# Marks of labels that contain a word, the mark of others, the text without a label.
ACTIVITY_BADGES = ([(("hyper",), "🔥"), (("active",), "⚡"), (("moderate",), "📈")], "⏳", "⚪ Unknown")
STRATEGY_BADGES = ([(("single",), "🎵"), (("hybrid", "balanced"), "⚖️")], "💿", "⚪ Unclassified")
