"""Independent SQL (DuckDB) for the registered queries.

Every statement starts from the driver tables: the shared CTEs derive the raw
snapshots, clean them and build the star in plain SQL, then each query states its
result.  Doubles are rounded half-up on their shortest decimal text, because the
two engines disagree on binary ties otherwise.
"""

from __future__ import annotations

from snapcat.registry import LAST, LINK, NEXT, SNAPSHOTS, SOME_ARTIST, SOME_ARTISTS

FIRST, SECOND, THIRD, FOURTH, _ = SNAPSHOTS


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def pct(part: str, whole: str, digits: int | None = 2) -> str:
    value = f"{dbl(part)} * 100.0::DOUBLE / NULLIF({dbl(whole)}, 0.0::DOUBLE)"
    return value if digits is None else rnd(value, digits)


def ratio(part: str, whole: str, digits: int = 2) -> str:
    return rnd(f"{dbl(part)} / NULLIF({dbl(whole)}, 0.0::DOUBLE)", digits)


def pad(text: str, key: str) -> str:
    return f"CASE WHEN {key} % 11 = 0 THEN '  ' || {text} || '  ' ELSE {text} END"


def day(text: str) -> str:
    return f"DATE '{text}'"


def month_name(month: str) -> str:
    return f"CASE WHEN {month} BETWEEN 1 AND 12 THEN strftime(make_date(2024, {month}, 1), '%B') END"


# Formulas, labels and cut-offs that must equal those of the data model.
S_RECENT = "LEAST(100.0::DOUBLE, recent_releases_12m * 10.0::DOUBLE)"
S_GROWTH = """(CASE WHEN catalog_growth_pct IS NULL THEN 50.0::DOUBLE
  ELSE GREATEST(0.0::DOUBLE, LEAST(100.0::DOUBLE, 50.0::DOUBLE + catalog_growth_pct * 5.0::DOUBLE)) END)"""
S_CADENCE = """(CASE WHEN median_release_cadence_days IS NULL THEN 50.0::DOUBLE
  ELSE GREATEST(10.0::DOUBLE, LEAST(100.0::DOUBLE,
    100.0::DOUBLE - ((median_release_cadence_days - 14.0::DOUBLE) / 166.0::DOUBLE) * 90.0::DOUBLE)) END)"""
WEIGHTED = f"(0.40::DOUBLE * {S_RECENT} + 0.35::DOUBLE * {S_GROWTH} + 0.25::DOUBLE * {S_CADENCE})"
INDEX = rnd(f"GREATEST(0.0::DOUBLE, LEAST(100.0::DOUBLE, {WEIGHTED}))", 2)

TIER = """CASE WHEN catalog_momentum_index >= 75 THEN 'Elite Velocity (Top Tier)'
  WHEN catalog_momentum_index >= 60 THEN 'High Momentum (Active Campaign)'
  WHEN catalog_momentum_index >= 45 THEN 'Moderate Momentum (Steady Catalog)'
  ELSE 'Low Momentum / Dormant (Hiatus)' END"""
BADGE = """CASE WHEN catalog_momentum_index IS NULL THEN '⚪ Unranked'
  WHEN catalog_momentum_index >= 75 THEN '🔥 Hyper-Paced'
  WHEN catalog_momentum_index >= 50 THEN '⚡ High Velocity'
  WHEN catalog_momentum_index >= 25 THEN '📈 Steady Expansion' ELSE '⏳ Dormant / Archival' END"""
ACTIVITY = """CASE WHEN recent_releases_12m >= 10 THEN 'Hyper-Active (10+ drops/yr)'
  WHEN recent_releases_12m >= 5 THEN 'Active Campaign (5-9 drops/yr)'
  WHEN recent_releases_12m >= 1 THEN 'Moderate Maintenance (1-4 drops/yr)'
  ELSE 'Dormant / Hiatus (0 drops/yr)' END"""
RATIO = ratio("total_singles", "total_albums")
BY_RATIO = f"""CASE WHEN {RATIO} >= 5.0 THEN 'Single-Dominant (Streaming-First)'
  WHEN {RATIO} >= 2.0 THEN 'Balanced Hybrid' ELSE 'Album-Focused (Traditional)' END"""
SHARE = pct("total_singles", "total_albums + total_singles", None)
BY_SHARE = f"""CASE WHEN {SHARE} >= 80.0 THEN 'Single-Dominant (Streaming-First)'
  WHEN {SHARE} >= 60.0 THEN 'Balanced Hybrid' ELSE 'Album-Centric (Traditional)' END"""
BY_COUNT = """CASE WHEN prev_tracks IS NULL THEN 'Baseline Snapshot (Initial)'
  WHEN total_tracks > prev_tracks THEN 'Catalog Expansion (Active Growth)'
  WHEN total_tracks = prev_tracks THEN 'Static Catalog (Zero Change)' ELSE 'Catalog Reduction (Delisting)' END"""
BY_PCT = """CASE WHEN catalog_growth_pct IS NULL THEN 'Baseline Snapshot (Initial)'
  WHEN catalog_growth_pct > 0 THEN 'Catalog Expansion (Active Growth)'
  WHEN catalog_growth_pct = 0 THEN 'Static Catalog (Zero Change)' ELSE 'Catalog Pruning / Retractions' END"""
DIRECTION = """CASE WHEN prev_momentum IS NULL THEN 'Initial Observation'
  WHEN catalog_momentum_index > prev_momentum THEN 'Surging (+)'
  WHEN catalog_momentum_index < prev_momentum THEN 'Decelerating (-)' ELSE 'Stable (0.0)' END"""
ARCHETYPE = """CASE WHEN release_month IN (6, 7) THEN 'Summer Single Surge (Streaming Peak)'
  WHEN release_month IN (10, 11) THEN 'Q4 Holiday & Grammy Window (LP Heavy)'
  WHEN release_month = 5 THEN 'Late Spring Festival Pre-Release'
  WHEN release_month IN (1, 2) THEN 'Q1 Industry Cooldown & Singles Reset' ELSE 'Mid-Season Catalog Drops' END"""
DELTA = rnd("catalog_momentum_index - prev_momentum", 2)
LATEST = "(SELECT max(snapshot_date) FROM fact)"

_ARTIST_NO = "CASE WHEN {k} < 100 THEN {k} // 10 ELSE {k} END"

BASE = f"""
WITH snaps AS (SELECT unnest([{', '.join(day(s) for s in SNAPSHOTS)}]) AS s),
cust AS (SELECT *, {_ARTIST_NO.format(k='c_custkey')} AS a FROM customer),
ords AS (SELECT *, {_ARTIST_NO.format(k='o_custkey')} AS a, CAST(o_orderdate AS DATE) AS od FROM orders),
raw_artists AS (
  SELECT {pad("'c' || a", 'c_custkey')} AS artist_id, {pad('c_name', 'c_custkey')} AS artist_name,
    'catalog:artist:' || c_custkey AS external_uri,
    CASE WHEN c_custkey % 7 <> 0 THEN 'img/' || c_custkey END AS image_url,
    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS genre,
    CAST(s AS TIMESTAMP) + to_seconds(c_custkey) AS extracted_at, s AS snapshot_date
  FROM cust CROSS JOIN snaps
  WHERE NOT (c_custkey >= 100 AND c_custkey % 50 = 7) AND NOT (a % 10 = 3 AND s = {day(THIRD)})
),
raw_albums AS (
  SELECT {pad("'o' || o_orderkey", 'o_orderkey')} AS album_id,
    {pad("'Release ' || o_orderkey", 'o_orderkey')} AS album_name,
    CASE o_orderstatus WHEN 'F' THEN 'ALBUM' WHEN 'O' THEN 'Single' ELSE 'Compilation' END AS album_type,
    CASE o_orderkey % 20 WHEN 0 THEN strftime(od, '%Y') WHEN 1 THEN strftime(od, '%Y-%m') WHEN 2 THEN 'N/A'
      WHEN 3 THEN '' ELSE strftime(od, '%Y-%m-%d') END AS release_date,
    CASE o_orderkey % 20 WHEN 0 THEN ' YEAR' WHEN 1 THEN 'Month ' ELSE 'day' END AS release_date_precision,
    CAST(o_orderkey % 23 AS INTEGER) AS total_tracks, {pad("'c' || a", 'o_orderkey')} AS artist_id,
    'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS artist_name,
    'catalog:album:' || o_orderkey AS external_uri,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'img/a' || o_orderkey END AS image_url,
    CAST(s AS TIMESTAMP) AS extracted_at, s AS snapshot_date
  FROM ords CROSS JOIN snaps WHERE o_orderkey % 97 <> 0 AND od <= s + 30
),
raw_tracks AS (
  SELECT {pad("'o' || l_orderkey || '-' || l_linenumber", 'l_orderkey')} AS track_id,
    'Part ' || l_partkey || ' of ' || l_suppkey AS track_name,
    CAST(round(l_extendedprice * 4) AS BIGINT) AS duration_ms,
    CASE WHEN l_partkey % 17 <> 0 THEN l_returnflag = 'R' END AS explicit,
    CAST(l_linenumber AS INTEGER) AS track_number,
    CASE WHEN l_partkey % 5 <> 0 THEN 1 END AS disc_number,
    {pad("'o' || l_orderkey", 'l_orderkey')} AS album_id, {pad("'c' || a", 'l_orderkey')} AS artist_id,
    'catalog:track:' || l_orderkey || '-' || l_linenumber AS external_uri,
    CAST(l_shipdate AS TIMESTAMP) AS extracted_at, s AS snapshot_date
  FROM lineitem JOIN ords ON l_orderkey = o_orderkey CROSS JOIN snaps
  WHERE od <= s + 30 AND CAST(l_shipdate AS DATE) <= s
    AND NOT (s = {day(LAST)} AND a % 9 = 4 AND l_linenumber > 2)
    AND NOT (s = {day(FOURTH)} AND a % 9 = 5 AND l_linenumber = 7 AND l_returnflag = 'R')
),
clean_artists AS (
  SELECT trim(artist_id) AS artist_id, trim(artist_name) AS artist_name, external_uri, image_url,
    coalesce(genre, '') AS genres, extracted_at, snapshot_date FROM raw_artists
),
texted_albums AS (
  SELECT *, CASE WHEN trim(release_date) NOT IN ('', 'N/A', 'null') THEN trim(release_date) END AS t FROM raw_albums
),
clean_albums AS (
  SELECT trim(album_id) AS album_id, trim(album_name) AS album_name, lower(trim(album_type)) AS album_type,
    TRY_CAST(CASE length(t) WHEN 4 THEN t || '-01-01' WHEN 7 THEN t || '-01' ELSE t END AS DATE) AS release_date,
    CASE WHEN length(t) >= 4 THEN TRY_CAST(substring(t, 1, 4) AS INTEGER) END AS release_year,
    CASE WHEN length(t) >= 7 THEN TRY_CAST(substring(t, 6, 2) AS INTEGER) WHEN length(t) >= 4 THEN 1 END AS release_month,
    CASE WHEN length(t) >= 4 THEN (TRY_CAST(substring(t, 1, 4) AS INTEGER) // 10 * 10) || 's' END AS release_decade,
    lower(trim(release_date_precision)) AS release_date_precision, total_tracks, trim(artist_id) AS artist_id,
    artist_name, external_uri, image_url, extracted_at, snapshot_date FROM texted_albums
),
clean_tracks AS (
  SELECT trim(track_id) AS track_id, track_name, duration_ms,
    {rnd('CAST(duration_ms AS DOUBLE) / 60000.0::DOUBLE', 2)} AS duration_min,
    {rnd('CAST(duration_ms AS DOUBLE) / 1000.0::DOUBLE', 1)} AS duration_sec,
    coalesce(explicit, false) AS explicit, track_number, coalesce(disc_number, 1) AS disc_number,
    trim(album_id) AS album_id, trim(artist_id) AS artist_id, external_uri, extracted_at, snapshot_date FROM raw_tracks
),
sa AS (SELECT * FROM clean_artists
  QUALIFY row_number() OVER (PARTITION BY artist_id, snapshot_date ORDER BY extracted_at DESC) = 1),
sb AS (SELECT * FROM clean_albums
  QUALIFY row_number() OVER (PARTITION BY album_id, snapshot_date ORDER BY extracted_at DESC) = 1),
st AS (SELECT * FROM clean_tracks
  QUALIFY row_number() OVER (PARTITION BY track_id, snapshot_date
    ORDER BY extracted_at DESC, track_name, duration_ms, explicit) = 1),
da AS (SELECT md5(artist_id) AS artist_key, artist_id, artist_name, genres, external_uri, image_url FROM sa
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY snapshot_date DESC) = 1),
db AS (SELECT md5(album_id) AS album_key, album_id, md5(artist_id) AS artist_key, artist_id, album_name, album_type,
    release_date, release_year, release_month, release_decade, release_date_precision, total_tracks, external_uri,
    image_url FROM sb
  QUALIFY row_number() OVER (PARTITION BY album_id ORDER BY snapshot_date DESC) = 1),
dt AS (SELECT md5(track_id) AS track_key, track_id, md5(album_id) AS album_key, album_id,
    md5(artist_id) AS artist_key, artist_id, track_name, duration_ms, duration_min, duration_sec, explicit,
    track_number, disc_number, external_uri FROM st
  QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY snapshot_date DESC) = 1),
track_totals AS (SELECT artist_id, snapshot_date, count(DISTINCT track_id) AS total_tracks FROM st GROUP BY ALL),
album_totals AS (
  SELECT artist_id, snapshot_date,
    count(DISTINCT album_id) FILTER (album_type = 'album' AND release_date <= snapshot_date) AS total_albums,
    count(DISTINCT album_id) FILTER (album_type = 'single' AND release_date <= snapshot_date) AS total_singles,
    count(DISTINCT album_id) FILTER (album_type IN ('album', 'single')
      AND release_date BETWEEN snapshot_date - 365 AND snapshot_date) AS recent_releases_12m
  FROM sb GROUP BY ALL
),
days AS (SELECT DISTINCT artist_id, snapshot_date, release_date FROM sb WHERE release_date <= snapshot_date),
gaps AS (
  SELECT *, CAST(release_date - lag(release_date) OVER (PARTITION BY artist_id, snapshot_date ORDER BY release_date)
    AS INTEGER) AS gap_days FROM days
  QUALIFY gap_days IS NOT NULL
),
base AS (
  SELECT g.artist_id, g.snapshot_date, coalesce(total_albums, 0) AS total_albums,
    coalesce(total_tracks, 0) AS total_tracks, coalesce(total_singles, 0) AS total_singles,
    coalesce(recent_releases_12m, 0) AS recent_releases_12m, median_release_cadence_days
  FROM (SELECT DISTINCT artist_id, snapshot_date FROM sa) g
  LEFT JOIN album_totals USING (artist_id, snapshot_date)
  LEFT JOIN track_totals USING (artist_id, snapshot_date)
  LEFT JOIN (SELECT artist_id, snapshot_date, CAST(quantile_disc(gap_days, 0.5) AS DOUBLE)
    AS median_release_cadence_days FROM gaps GROUP BY ALL) USING (artist_id, snapshot_date)
),
grown AS (
  SELECT *, CASE WHEN p IS NOT NULL AND p <> 0
    THEN {rnd('CAST(total_tracks - p AS DOUBLE) / CAST(p AS DOUBLE) * 100.0::DOUBLE', 2)} END AS catalog_growth_pct
  FROM (SELECT *, lag(total_tracks) OVER (PARTITION BY artist_id ORDER BY snapshot_date) AS p FROM base)
),
fact AS (
  SELECT md5(artist_id) AS artist_key, CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key, artist_id,
    snapshot_date, total_albums, total_tracks, total_singles, recent_releases_12m, median_release_cadence_days,
    catalog_growth_pct, {INDEX} AS catalog_momentum_index FROM grown
),
fa AS (
  SELECT f.*, da.artist_name,
    lag(total_tracks) OVER (PARTITION BY f.artist_key ORDER BY snapshot_date) AS prev_tracks,
    lag(catalog_momentum_index) OVER (PARTITION BY f.artist_key ORDER BY snapshot_date) AS prev_momentum
  FROM fact f JOIN da ON f.artist_key = da.artist_key
),
activity AS (
  SELECT snapshot_date, artist_key, artist_name, recent_releases_12m, total_albums, total_singles,
    total_albums + total_singles AS total_releases,
    {pct('total_singles', 'total_albums + total_singles', 1)} AS single_pct,
    {pct('total_albums', 'total_albums + total_singles', 1)} AS album_pct,
    {RATIO} AS single_to_album_ratio, {BY_RATIO} AS catalog_strategy,
    dense_rank() OVER (PARTITION BY snapshot_date
      ORDER BY recent_releases_12m DESC, total_albums + total_singles DESC) AS activity_rank,
    {ACTIVITY} AS activity_tier FROM fa
),
growth AS (
  SELECT snapshot_date, artist_key, artist_name, prev_tracks, total_tracks AS current_tracks,
    coalesce(total_tracks - prev_tracks, 0) AS net_tracks_added, catalog_growth_pct,
    {BY_COUNT} AS growth_classification,
    dense_rank() OVER (PARTITION BY snapshot_date
      ORDER BY coalesce(total_tracks - prev_tracks, 0) DESC, total_tracks DESC) AS expansion_rank FROM fa
),
by_month AS (
  SELECT release_month, count(*) AS total_releases, count(*) FILTER (album_type = 'album') AS studio_albums,
    count(*) FILTER (album_type = 'single') AS singles, count(*) FILTER (album_type = 'compilation') AS compilations
  FROM db WHERE release_month IS NOT NULL GROUP BY release_month
),
seasonality AS (
  SELECT release_month, {month_name('release_month')} AS month_name, total_releases, studio_albums, singles,
    compilations, {pct('singles', 'total_releases', 1)} AS single_share_pct,
    {pct('studio_albums', 'total_releases', 1)} AS album_share_pct,
    dense_rank() OVER (ORDER BY total_releases DESC) AS volume_rank,
    {ARCHETYPE} AS industry_season_archetype FROM by_month
),
momentum AS (
  SELECT snapshot_date, artist_key, artist_name, catalog_momentum_index,
    dense_rank() OVER (PARTITION BY snapshot_date ORDER BY catalog_momentum_index DESC) AS momentum_rank,
    {TIER} AS momentum_tier, {rnd('0.40::DOUBLE * ' + S_RECENT, 1)} AS volume_score,
    {rnd('0.35::DOUBLE * ' + S_GROWTH, 1)} AS growth_score, {rnd('0.25::DOUBLE * ' + S_CADENCE, 1)} AS cadence_score,
    recent_releases_12m, median_release_cadence_days, catalog_growth_pct, total_tracks, prev_momentum,
    {DELTA} AS momentum_delta, {DIRECTION} AS trajectory_direction FROM fa
),
named_tracks AS (
  SELECT dt.*, db.album_name, db.album_type, db.release_date, da.artist_name
  FROM dt JOIN db ON dt.album_key = db.album_key JOIN da ON db.artist_key = da.artist_key
),
artist_month AS (
  SELECT artist_name, release_month, count(*) AS releases_in_month,
    CAST(sum(count(*)) OVER (PARTITION BY artist_name) AS BIGINT) AS lifetime_releases
  FROM db JOIN da ON db.artist_key = da.artist_key GROUP BY artist_name, release_month
),
profile AS (
  SELECT *, {rnd(f'{S_RECENT}', 1)} AS s_recent, {rnd(S_GROWTH, 1)} AS s_growth, {rnd(S_CADENCE, 1)} AS s_cadence,
    {rnd(WEIGHTED, 2)} AS momentum_index
  FROM (
    SELECT *, CASE WHEN p <> 0 THEN
      {rnd('CAST(total_tracks - p AS DOUBLE) / CAST(p AS DOUBLE) * 100.0::DOUBLE', 2)} END AS catalog_growth_pct
    FROM (
      SELECT b.*, (SELECT max(q.total_tracks) FROM (SELECT artist_id, snapshot_date, total_tracks FROM profile_base) q
        WHERE q.artist_id = b.artist_id AND q.snapshot_date = b.before) AS p
      FROM (
        SELECT pb.*, (SELECT max(s) FROM snaps WHERE s < pb.snapshot_date) AS before FROM profile_base pb
      ) b
    )
  )
)
"""

PROFILE_BASE = """profile_base AS (
  SELECT sa.artist_id, sa.artist_name, sa.snapshot_date, coalesce(al.total_albums, 0) AS total_albums,
    coalesce(al.total_singles, 0) AS total_singles, coalesce(al.total_compilations, 0) AS total_compilations,
    coalesce(tr.total_tracks, 0) AS total_tracks, coalesce(al.recent_releases_12m, 0) AS recent_releases_12m,
    md.m AS median_release_cadence_days
  FROM sa
  LEFT JOIN (SELECT artist_id, snapshot_date, count(*) FILTER (album_type = 'album') AS total_albums,
      count(*) FILTER (album_type = 'single') AS total_singles,
      count(*) FILTER (album_type = 'compilation') AS total_compilations,
      count(*) FILTER (album_type IN ('album', 'single')
        AND release_date BETWEEN snapshot_date - 365 AND snapshot_date) AS recent_releases_12m
    FROM sb GROUP BY ALL) al USING (artist_id, snapshot_date)
  LEFT JOIN (SELECT artist_id, snapshot_date, count(*) AS total_tracks FROM st GROUP BY ALL) tr
    USING (artist_id, snapshot_date)
  LEFT JOIN (SELECT artist_id, snapshot_date, CAST(median(gap_days) AS DOUBLE) AS m FROM gaps GROUP BY ALL) md
    USING (artist_id, snapshot_date)
),
"""
BASE = BASE.replace("profile AS (", PROFILE_BASE + "profile AS (", 1).strip()


# --- Data-quality rules in SQL ----------------------------------------------


def rule(
    name: str, entity: str, target: str, status: str, total: str, violations: str, rate: str, detail: str, source: str
) -> str:
    return (
        f"SELECT '{name}' AS rule, '{entity}' AS entity, '{target}' AS target, snapshot_date, {status} AS status, "
        f"CAST({total} AS BIGINT) AS total_rows, CAST({violations} AS BIGINT) AS violations, "
        f"CAST({rate} AS DOUBLE) AS rate_pct, {detail} AS detail FROM {source}"
    )


def completeness(table: str, entity: str, minimum: int = 1) -> str:
    return rule(
        "completeness", entity, "", f"CASE WHEN n < {minimum} THEN 'FAIL' ELSE 'PASS' END", "n",
        f"greatest({minimum} - n, 0)", "0", f"'min_expected={minimum}'",
        f"(SELECT snapshot_date, count(*) AS n FROM {table} GROUP BY ALL)",
    )


def uniqueness(table: str, entity: str, key: str) -> str:
    return rule(
        "uniqueness", entity, key, "CASE WHEN n > k THEN 'FAIL' ELSE 'PASS' END", "n", "n - k",
        rnd("CAST(n - k AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE", 2), "'distinct_keys=' || k",
        f"(SELECT snapshot_date, count(*) AS n, count(DISTINCT {key}) AS k FROM {table} GROUP BY ALL)",
    )


def counted(name: str, table: str, entity: str, conditions: dict[str, str]) -> str:
    cols = ", ".join(f"count(*) FILTER ({c}) AS v{i}" for i, c in enumerate(conditions.values()))
    total = " + ".join(f"v{i}" for i in range(len(conditions)))
    detail = " || ',' || ".join(f"'{label}=' || v{i}" for i, label in enumerate(conditions))
    return rule(
        name, entity, ",".join(conditions), f"CASE WHEN {total} > 0 THEN 'FAIL' ELSE 'PASS' END", "n", total, "0",
        detail, f"(SELECT snapshot_date, count(*) AS n, {cols} FROM {table} GROUP BY ALL)",
    )


def nulls(table: str, entity: str, columns: list[str]) -> str:
    return counted(
        "critical_nulls", table, entity, {c: f"{c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''" for c in columns}
    )


def referential(child: str, parent: str, key: str, child_entity: str, parent_entity: str) -> str:
    rate = rnd("CAST(o AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE", 2)
    return rule(
        "referential_integrity", child_entity, f"{key}->{parent_entity}",
        f"CASE WHEN o = 0 THEN 'PASS' WHEN {rate} <= 5.0 THEN 'WARN' ELSE 'FAIL' END", "n", "o", rate,
        "'threshold_pct=5.0'",
        f"""(SELECT c.snapshot_date, count(*) AS n, count(*) FILTER (NOT EXISTS (SELECT 1 FROM {parent} p
          WHERE p.{key} = c.{key} AND p.snapshot_date = c.snapshot_date)) AS o FROM {child} c GROUP BY ALL)""",
    )


TRACK_RANGES = {
    "duration_ms": "duration_ms < 1 OR duration_ms > 7200000",
    "track_number": "track_number < 1",
    "disc_number": "disc_number < 1",
}
GATE = " UNION ALL ".join([
    completeness("sa", "artists"), completeness("sb", "albums"), completeness("st", "tracks"),
    uniqueness("sa", "artists", "artist_id"), uniqueness("sb", "albums", "album_id"),
    uniqueness("st", "tracks", "track_id"),
    nulls("sa", "artists", ["artist_id", "artist_name"]),
    nulls("sb", "albums", ["album_id", "album_name", "artist_id"]),
    nulls("st", "tracks", ["track_id", "track_name", "album_id", "artist_id"]),
    referential("sb", "sa", "artist_id", "albums", "artists"),
    referential("st", "sb", "album_id", "tracks", "albums"),
    referential("st", "sa", "artist_id", "tracks", "artists"),
    counted("value_ranges", "st", "tracks", TRACK_RANGES),
])
REPORT = f"""SELECT snapshot_date,
  CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS overall_status,
  count(*) AS total_checks, count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'WARN') AS warnings,
  count(*) FILTER (status = 'FAIL') AS failed,
  {rnd("CAST(count(*) FILTER (status = 'PASS') AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0::DOUBLE", 2)} AS success_rate_pct
  FROM ({GATE}) GROUP BY snapshot_date"""

_ORPHAN_ALBUMS = """sb c WHERE NOT EXISTS (SELECT 1 FROM sa p
  WHERE p.artist_id = c.artist_id AND p.snapshot_date = c.snapshot_date)"""


def merged(table: str, key: str, columns: str, base: str, change: str, delta_wins: bool) -> str:
    winner, other = (change, base) if delta_wins else (base, change)
    return f"""SELECT {columns}, {day(NEXT)} AS snapshot_date FROM {table} WHERE snapshot_date = {day(winner)}
      UNION ALL SELECT {columns}, {day(NEXT)} FROM {table} WHERE snapshot_date = {day(other)}
        AND {key} NOT IN (SELECT {key} FROM {table} WHERE snapshot_date = {day(winner)})"""


def _with_base(table: str, key: str, columns: str, base: str, change: str, delta_wins: bool) -> str:
    """The merged snapshot beside the one that it was merged into."""
    return f"""{merged(table, key, columns, base, change, delta_wins)}
      UNION ALL SELECT {columns}, snapshot_date FROM {table} WHERE snapshot_date = {day(base)}"""


def distribution(metric: str, column: str) -> str:
    return f"""SELECT snapshot_date, '{metric}' AS metric, CAST(min({column}) AS DOUBLE) AS min_value,
      CAST(max({column}) AS DOUBLE) AS max_value, CAST(median({column}) AS DOUBLE) AS median_value,
      {rnd(f'avg({column})', 2)} AS mean_value FROM profile_out GROUP BY snapshot_date"""


PROFILE_OUT = f"""SELECT artist_id, snapshot_date, artist_name, total_albums, total_singles, total_compilations,
  total_tracks, recent_releases_12m, {rnd('median_release_cadence_days', 1)} AS median_cadence_days,
  catalog_growth_pct AS growth_pct, s_recent, s_growth, s_cadence, momentum_index FROM profile"""


def compact(v: str) -> str:
    return f"""CASE WHEN abs({v}) >= 1000000 THEN format('{{:.1f}}M', {v} / 1000000.0::DOUBLE)
      WHEN abs({v}) >= 1000 THEN format('{{:.1f}}K', {v} / 1000.0::DOUBLE) ELSE CAST({v} AS VARCHAR) END"""


_ALL_RAW = "external_uri, image_url, extracted_at, snapshot_date"
_WRITTEN = """SELECT {d} AS snapshot_date, 'artists' AS entity, count(*) AS rows_read_back, count(*) AS rows_written
    FROM {a} WHERE snapshot_date = {d}
  UNION ALL SELECT {d}, 'albums', count(*), count(*) FROM {b} WHERE snapshot_date = {d}
  UNION ALL SELECT {d}, 'tracks', count(*), count(*) FROM {t} WHERE snapshot_date = {d}"""
_PRESENT = ", ".join(
    f"""coalesce(bool_or(snapshot_date = {day(s)}), false) AS present_{s.replace('-', '')},
    max(CASE WHEN snapshot_date = {day(s)} THEN track_count END) AS tracks_{s.replace('-', '')}"""
    for s in SNAPSHOTS
)
_MISSING = "concat_ws(','" + "".join(
    f""", CASE WHEN NOT present_{s.replace('-', '')} AND ({' OR '.join(
        f"present_{b.replace('-', '')}" for b in SNAPSHOTS[:i]) or 'false'}) THEN '{s}' END"""
    for i, s in enumerate(SNAPSHOTS)
) + ")"
_BRONZE_ALBUMS = """trim(album_id) AS album_id, trim(album_name) AS album_name, album_type, release_date,
  release_date_precision, total_tracks, trim(artist_id) AS artist_id, artist_name, external_uri, image_url,
  extracted_at, snapshot_date, 'catalog-api' AS source"""
_NAMES = ", ".join(f"'{n}'" for n in SOME_ARTISTS)
_EXPLORE = f"""track_name, artist_name, album_name, album_type, CAST(release_date AS VARCHAR) AS release_date, duration_ms,
  {rnd('CAST(duration_ms AS DOUBLE) / 60000.0::DOUBLE', 2)} AS duration_min, explicit, disc_number, track_number,
  '{LINK}track/' || track_id AS track_url"""
_EXPLORE_ORDER = "ORDER BY named_tracks.release_date DESC NULLS LAST, track_number ASC NULLS LAST, track_url"
_TRENDS = """SELECT b.release_year, b.album_type, b.snapshot_date, count(*) AS total_releases,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS total_tracks, sum(ms) AS ms, sum(timed) AS timed, sum(e) AS e
  FROM sb b LEFT JOIN (SELECT album_id, snapshot_date, count(*) AS n, sum(duration_ms) AS ms,
    count(duration_ms) AS timed, count(*) FILTER (explicit) AS e FROM st GROUP BY ALL) t USING (album_id, snapshot_date)
  WHERE release_year IS NOT NULL GROUP BY ALL"""
_DURATIONS = f"""SELECT artist_name, track_name, {rnd('CAST(duration_ms AS DOUBLE) / 60000.0::DOUBLE', 2)} AS duration_min,
  album_type, CAST(year(release_date) AS INTEGER) AS release_year, explicit FROM named_tracks
  WHERE duration_ms > 0 AND duration_ms < 1200000"""
_GATED = f"""
  SELECT snapshot_date, overall_status, output, count(*) AS row_count
  FROM (SELECT snapshot_date, overall_status FROM ({REPORT}) WHERE overall_status <> 'FAIL') JOIN (
    SELECT snapshot_date, 'silver_artists' AS output FROM sa
    UNION ALL SELECT snapshot_date, 'silver_albums' FROM sb c
      WHERE EXISTS (SELECT 1 FROM sa p WHERE p.artist_id = c.artist_id AND p.snapshot_date = c.snapshot_date)
    UNION ALL SELECT snapshot_date, 'silver_tracks' FROM st c
      WHERE EXISTS (SELECT 1 FROM sb p WHERE p.album_id = c.album_id AND p.snapshot_date = c.snapshot_date)
    UNION ALL SELECT snapshot_date, 'quarantine_albums' FROM {_ORPHAN_ALBUMS}
    UNION ALL SELECT snapshot_date, 'quarantine_tracks' FROM st c
      WHERE NOT EXISTS (SELECT 1 FROM sb p WHERE p.album_id = c.album_id AND p.snapshot_date = c.snapshot_date)
  ) USING (snapshot_date) GROUP BY ALL
  UNION ALL SELECT snapshot_date, overall_status, NULL, NULL FROM ({REPORT}) WHERE overall_status = 'FAIL'"""
_KEPT_ALBUM = """EXISTS (SELECT 1 FROM sb b JOIN sa a ON a.artist_id = b.artist_id AND a.snapshot_date = b.snapshot_date
  WHERE b.album_id = c.album_id AND b.snapshot_date = c.snapshot_date)"""
_CALENDAR = """SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
  AS full_date FROM orders"""
_DIM_DATE = f"""SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
  CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
  CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
  CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, CAST(day(full_date) AS INTEGER) AS day_of_month,
  CAST(isodow(full_date) AS INTEGER) AS day_of_week, strftime(full_date, '%A') AS day_name,
  isodow(full_date) >= 6 AS is_weekend FROM ({_CALENDAR})"""

_FINAL: dict[str, str] = {
    # scans, sources, sinks
    "scan_raw_json": f"""SELECT album_id, album_name, album_type, release_date, release_date_precision, total_tracks,
        artist_id, artist_name, external_uri, image_url,
        strftime(extracted_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS extracted_at,
        CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM raw_albums WHERE snapshot_date = {day(LAST)}""",
    "scan_snapshot": f"SELECT *, 'catalog-api' AS source FROM sb WHERE snapshot_date = {day(LAST)}",
    "register_gold_views": f"""SELECT 'dim_date' AS view_name, count(*) AS row_count FROM ({_CALENDAR})
        UNION ALL SELECT 'dim_artist', count(*) FROM da UNION ALL SELECT 'dim_album', count(*) FROM db
        UNION ALL SELECT 'dim_track', count(*) FROM dt UNION ALL SELECT 'fact_artist_snapshot', count(*) FROM fact""",
    "gold_view_join": f"""SELECT d.year, d.month_name, snapshot_date, artist_name, total_tracks, recent_releases_12m,
        median_release_cadence_days, catalog_growth_pct, catalog_momentum_index
        FROM fa LEFT JOIN ({_DIM_DATE}) d ON fa.date_key = d.date_key""",
    "write_snapshot": f"""SELECT album_id, album_type, release_date, snapshot_date FROM sb
        WHERE snapshot_date <> {day(LAST)} OR album_type = 'album'""",
    "write_dimension": "SELECT * FROM da",
    "quarantine": f"""SELECT album_id, artist_id, 'referential_integrity' AS dq_rule, 'orphan_artist_id' AS dq_reason,
        snapshot_date FROM {_ORPHAN_ALBUMS}""",
    "write_dq_report": f"""SELECT g.*, r.overall_status, r.success_rate_pct FROM ({GATE}) g
        JOIN ({REPORT}) r ON g.snapshot_date = r.snapshot_date""",
    "quarantine_rerun": f"""SELECT album_id, artist_id, 'referential_integrity' AS dq_rule, 'orphan_artist_id' AS dq_reason,
        snapshot_date FROM {_ORPHAN_ALBUMS}""",
    "footprint_rows": """SELECT entity, layer, row_count, row_count = expected AS rows_as_expected FROM (
        SELECT 'artists' AS entity, 'raw' AS layer, count(*) AS row_count, (SELECT count(*) FROM raw_artists) AS expected FROM raw_artists
        UNION ALL SELECT 'artists', 'silver', count(*), (SELECT count(*) FROM raw_artists) FROM sa
        UNION ALL SELECT 'albums', 'raw', count(*), (SELECT count(*) FROM raw_albums) FROM raw_albums
        UNION ALL SELECT 'albums', 'silver', count(*), (SELECT count(*) FROM raw_albums) FROM sb
        UNION ALL SELECT 'tracks', 'raw', count(*), (SELECT count(*) FROM raw_tracks) FROM raw_tracks
        UNION ALL SELECT 'tracks', 'silver', count(*), (SELECT count(*) FROM raw_tracks) FROM st)""",
    "generate_calendar": _CALENDAR,
    "corrupt_record_split": """SELECT CASE WHEN k % 29 = 0 THEN 'bad' ELSE 'good' END AS kind,
        CASE WHEN k % 29 = 0 THEN '{"artist_id": "' || k || '", "artist_na' ELSE external_uri END AS record
        FROM (SELECT *, CAST(split_part(external_uri, ':', 3) AS BIGINT) AS k FROM raw_artists)""",
    # projections, filters
    "bronze_artists": """SELECT trim(artist_id) AS artist_id, trim(artist_name) AS artist_name, external_uri, image_url,
        genre AS genres, extracted_at, snapshot_date, 'catalog-api' AS source FROM raw_artists""",
    "bronze_albums": f"SELECT {_BRONZE_ALBUMS} FROM raw_albums",
    "bronze_tracks": """SELECT track_id, track_name, duration_ms, explicit, track_number, disc_number, album_id, artist_id,
        external_uri, extracted_at, snapshot_date, 'catalog-api' AS source FROM clean_tracks""",
    "bronze_snapshot": _WRITTEN.format(d=day(LAST), a="raw_artists", b="raw_albums", t="raw_tracks"),
    "silver_snapshot": _WRITTEN.format(d=day(LAST), a="sa", b="sb", t="st"),
    "clean_artists": "SELECT *, 'catalog-api' AS source FROM clean_artists",
    "clean_albums": "SELECT * FROM clean_albums",
    "clean_tracks": "SELECT * FROM clean_tracks",
    "nullify_sentinels": "SELECT trim(album_id) AS album_id, snapshot_date, t AS release_text FROM texted_albums",
    "normalize_partial_date": "SELECT album_id, snapshot_date, release_date FROM clean_albums",
    "derive_release_parts": """SELECT trim(album_id) AS album_id, snapshot_date,
        CASE WHEN length(t) >= 4 THEN CAST(left(t, 4) AS INTEGER) END AS release_year,
        CASE WHEN length(t) >= 7 THEN CAST(substring(t, 6, 2) AS INTEGER) WHEN length(t) >= 4 THEN 1 END AS release_month,
        CASE WHEN length(t) >= 7 THEN CAST(substring(t, 6, 2) AS INTEGER) END AS known_month,
        left(t, 3) || '0s' AS release_decade FROM texted_albums""",
    "derive_durations": "SELECT external_uri, snapshot_date, duration_ms, duration_min, duration_sec FROM clean_tracks",
    "normalize_track_types": "SELECT external_uri, snapshot_date, explicit, track_number, disc_number FROM clean_tracks",
    "normalize_categories": "SELECT album_id, snapshot_date, album_type, release_date_precision FROM clean_albums",
    "latest_snapshot_filter": f"SELECT * FROM fact WHERE snapshot_date = {LATEST}",
    "asof_release_filter": "SELECT album_id, snapshot_date, release_date FROM sb WHERE release_date <= snapshot_date",
    "since_filter": """SELECT trim(album_id) AS album_id, snapshot_date, release_date FROM raw_albums
        WHERE release_date IS NULL OR release_date = '' OR release_date >= '1999-01-01'""",
    "since_filter_by_date": """SELECT trim(album_id) AS album_id, snapshot_date, release_date FROM texted_albums
        WHERE coalesce(TRY_CAST(CASE length(t) WHEN 4 THEN t || '-01-01' WHEN 7 THEN t || '-01' ELSE t END AS DATE)
          >= DATE '1999-01-01', true)""",
    "explore_tracks": f"""SELECT {_EXPLORE} FROM named_tracks WHERE artist_name IN ({_NAMES})
        AND album_type IN ('album', 'single') {_EXPLORE_ORDER} LIMIT 500""",
    "explore_all_tracks": f"SELECT {_EXPLORE} FROM named_tracks {_EXPLORE_ORDER}",
    "range_filters": """SELECT track_id, snapshot_date, duration_ms, track_number FROM st
        WHERE duration_ms > 0 AND duration_ms < 1200000 AND track_number BETWEEN 2 AND 5""",
    "display_track_columns": f"""SELECT track_id, CASE WHEN duration_ms > 0 THEN
          lpad(CAST(duration_ms // 60000 AS VARCHAR), CAST(greatest(2, length(CAST(duration_ms // 60000 AS VARCHAR))) AS INTEGER), '0')
          || ':' || lpad(CAST(duration_ms // 1000 % 60 AS VARCHAR), 2, '0') ELSE '00:00' END AS duration_text,
        '{LINK}track/' || track_id AS track_url, {compact('duration_ms')} AS length_compact,
        format('{{:,}}', duration_ms) AS length_grouped FROM dt""",
    "display_artist_columns": f"""SELECT m.artist_key, m.snapshot_date, m.artist_name, {BADGE} AS momentum_badge,
        CASE WHEN activity_tier LIKE 'Hyper%' THEN '🔥 ' WHEN activity_tier LIKE 'Active%' THEN '⚡ '
          WHEN activity_tier LIKE 'Moderate%' THEN '📈 ' ELSE '⏳ ' END || activity_tier AS activity_badge,
        CASE WHEN catalog_strategy LIKE 'Single%' THEN '🎵 ' WHEN catalog_strategy LIKE 'Balanced%' THEN '⚖️ '
          ELSE '💿 ' END || catalog_strategy AS strategy_badge, {compact('m.total_tracks')} AS tracks_compact,
        coalesce(format('{{:.1f}}%', single_pct), '—') AS single_share,
        coalesce(format('{{:.2f}}%', catalog_growth_pct), '—') AS growth
        FROM momentum m JOIN activity a ON m.artist_key = a.artist_key AND m.snapshot_date = a.snapshot_date""",
    # joins
    "snapshot_grid_join": """SELECT artist_id, snapshot_date, total_albums, total_singles, recent_releases_12m,
        total_tracks FROM base""",
    "fact_dim_join": "SELECT artist_key, snapshot_date, artist_name, total_tracks, catalog_momentum_index FROM fa",
    "orphan_audit_left_join": """SELECT snapshot_date, count(*) AS total_rows, count(*) - count(d.artist_key) AS orphan_count
        FROM fact f LEFT JOIN (SELECT artist_key FROM da WHERE image_url IS NOT NULL) d ON f.artist_key = d.artist_key
        GROUP BY snapshot_date""",
    "orphans_anti": f"SELECT album_id, artist_id, snapshot_date FROM {_ORPHAN_ALBUMS}",
    "keep_with_parent_semi": """SELECT track_id, album_id, snapshot_date FROM st c WHERE EXISTS (SELECT 1 FROM sb p
        WHERE p.album_id = c.album_id AND p.snapshot_date = c.snapshot_date)""",
    "orphans_null_filter": """SELECT track_id, dt.album_id FROM dt LEFT JOIN db ON dt.album_key = db.album_key
        WHERE db.album_key IS NULL""",
    "track_album_artist_join": """SELECT track_id, track_name, duration_ms, explicit, disc_number, track_number,
        album_name, album_type, release_date, artist_name FROM named_tracks""",
    "artist_profile": f"""SELECT da.artist_name, da.genres, da.external_uri, da.image_url, m.snapshot_date,
        m.catalog_momentum_index, m.momentum_rank, m.momentum_tier, m.volume_score, m.growth_score, m.cadence_score,
        m.recent_releases_12m, m.median_release_cadence_days, m.catalog_growth_pct, m.total_tracks, m.momentum_delta,
        m.trajectory_direction, a.total_albums, a.total_singles, a.catalog_strategy, a.activity_tier
        FROM momentum m JOIN da ON m.artist_key = da.artist_key
        LEFT JOIN activity a ON m.artist_key = a.artist_key AND m.snapshot_date = a.snapshot_date
        WHERE da.artist_name = '{SOME_ARTIST}' AND m.snapshot_date = {day(LAST)}""",
    "agg_self_join": f"SELECT *, {pct('releases_in_month', 'lifetime_releases', 1)} AS share_pct FROM artist_month",
    "presence_matrix": f"""SELECT *, {_MISSING} AS missing_in FROM (
        SELECT artist_id, arg_max(artist_name, snapshot_date) AS artist_name, {_PRESENT} FROM (
          SELECT sa.artist_id, sa.artist_name, sa.snapshot_date, coalesce(total_tracks, 0) AS track_count
          FROM sa LEFT JOIN track_totals t ON sa.artist_id = t.artist_id AND sa.snapshot_date = t.snapshot_date)
        GROUP BY artist_id)""",
    "missing_later": f"""SELECT artist_id, artist_name FROM sa WHERE snapshot_date = {day(SECOND)}
        AND artist_id NOT IN (SELECT artist_id FROM sa WHERE snapshot_date = {day(THIRD)})""",
    # aggregations
    "track_counts": "SELECT * FROM track_totals",
    "album_counts": "SELECT * FROM album_totals",
    "median_cadence": """SELECT artist_id, snapshot_date, CAST(quantile_disc(gap_days, 0.5) AS DOUBLE)
        AS median_release_cadence_days FROM gaps GROUP BY ALL""",
    "exact_median_cadence": """SELECT artist_id, snapshot_date, CAST(median(gap_days) AS DOUBLE) AS median_cadence_days
        FROM gaps GROUP BY ALL""",
    "metric_distribution": f""", profile_out AS ({PROFILE_OUT}) """
    + " UNION ALL ".join(
        distribution(c, c) for c in ("recent_releases_12m", "median_cadence_days", "growth_pct", "momentum_index")
    ),
    "format_counts_by_month": """SELECT release_month, total_releases, studio_albums, singles, compilations,
        single_share_pct, album_share_pct FROM seasonality""",
    "format_evolution_by_year": """SELECT CAST(year(release_date) AS INTEGER) AS release_year,
        count(*) FILTER (album_type = 'album') AS studio_albums, count(*) FILTER (album_type = 'single') AS singles,
        count(*) AS total_releases FROM db WHERE year(release_date) BETWEEN 1970 AND 2026 GROUP BY 1""",
    "explicit_ratio": f"""SELECT artist_name, count(*) AS total_tracks, count(*) FILTER (explicit) AS explicit_tracks,
        {pct('count(*) FILTER (explicit)', 'count(*)', 1)} AS explicit_pct,
        {pct('count(*) FILTER (NOT explicit)', 'count(*)', 1)} AS clean_pct FROM named_tracks GROUP BY artist_name""",
    "cohort_sanity": f"""SELECT f.snapshot_date, count(*) AS total_fact_rows, count(DISTINCT f.artist_key) AS distinct_artists,
        count(DISTINCT da.artist_name) AS resolved_artist_names, CAST(sum(total_tracks) AS BIGINT) AS cohort_total_tracks,
        CAST(sum(total_albums) AS BIGINT) AS cohort_total_albums, CAST(sum(total_singles) AS BIGINT) AS cohort_total_singles,
        {rnd('avg(catalog_momentum_index)', 2)} AS cohort_avg_momentum,
        count(*) - count(da.artist_key) AS orphan_artist_count
        FROM fact f LEFT JOIN da ON f.artist_key = da.artist_key GROUP BY f.snapshot_date""",
    "executive_kpis": f"""SELECT count(DISTINCT artist_key) AS total_artists, CAST(sum(total_tracks) AS BIGINT) AS total_tracks,
        CAST(sum(total_albums) AS BIGINT) AS total_albums, CAST(sum(total_singles) AS BIGINT) AS total_singles,
        CAST(sum(recent_releases_12m) AS BIGINT) AS recent_releases_12m,
        {rnd('avg(catalog_momentum_index)', 1)} AS cohort_avg_momentum FROM fact WHERE snapshot_date = {day(LAST)}""",
    "strategy_distribution": f"""SELECT catalog_strategy, count(*) AS artist_count FROM activity
        WHERE snapshot_date = {day(LAST)} GROUP BY catalog_strategy""",
    "warehouse_health": f"""SELECT CAST((SELECT max(snapshot_date) FROM fact) AS VARCHAR) AS latest_snapshot,
        CAST((SELECT max(snapshot_date) FROM fact WHERE snapshot_date < {LATEST}) AS VARCHAR) AS previous_snapshot,
        (SELECT count(DISTINCT snapshot_date) FROM fact) AS total_snapshots, (SELECT count(*) FROM fact) AS total_facts,
        (SELECT count(DISTINCT artist_key) FROM da) AS artists_count, (SELECT count(DISTINCT album_key) FROM db) AS albums_count,
        (SELECT count(DISTINCT track_key) FROM dt) AS tracks_count,
        (SELECT arg_max(overall_status, snapshot_date) FROM ({REPORT})) AS dq_status""",
    "fact_rollup_by_snapshot": f"""SELECT snapshot_date, count(*) AS total_artists,
        CAST(sum(total_albums) AS BIGINT) AS total_albums, CAST(sum(total_tracks) AS BIGINT) AS total_tracks,
        {rnd('avg(catalog_momentum_index)', 2)} AS avg_momentum FROM fact GROUP BY snapshot_date""",
    "duplicate_key_groups": """SELECT track_id, snapshot_date, count(*) AS row_count FROM clean_tracks
        GROUP BY ALL HAVING count(*) > 1""",
    "cohort_growth": f"""SELECT snapshot_date, cohort_tracks, prev_cohort_tracks,
        {pct('cohort_tracks - prev_cohort_tracks', 'prev_cohort_tracks')} AS cohort_growth_pct FROM (
          SELECT snapshot_date, CAST(sum(total_tracks) AS BIGINT) AS cohort_tracks,
            CAST(lag(sum(total_tracks)) OVER (ORDER BY snapshot_date) AS BIGINT) AS prev_cohort_tracks
          FROM fact GROUP BY snapshot_date)""",
    "catalog_trends": f"""SELECT t.release_year, t.album_type, t.snapshot_date, total_releases, total_tracks,
        {rnd('CAST(ms AS DOUBLE) / CAST(NULLIF(timed, 0) AS DOUBLE) / 60000.0::DOUBLE', 2)} AS avg_track_duration_min,
        {ratio('e', 'CASE WHEN total_tracks > 0 THEN total_tracks END', 4)} AS explicit_track_ratio,
        {ratio('s', 'a')} AS single_to_album_ratio
        FROM ({_TRENDS}) t JOIN (SELECT release_year, snapshot_date, count(*) FILTER (album_type = 'single') AS s,
          count(*) FILTER (album_type = 'album') AS a FROM sb WHERE release_year IS NOT NULL GROUP BY ALL) r
        USING (release_year, snapshot_date)""",
    "duration_histogram": f""", d AS ({_DURATIONS}), q AS (SELECT min(duration_min) AS low,
          (max(duration_min) - min(duration_min)) / 40 AS width, {rnd('quantile_cont(duration_min, 0.25)', 4)} AS q1_min,
          {rnd('quantile_cont(duration_min, 0.5)', 4)} AS median_min,
          {rnd('quantile_cont(duration_min, 0.75)', 4)} AS q3_min FROM d)
        SELECT CAST(least(floor((duration_min - low) / width), 39) AS INTEGER) AS bin, count(*) AS track_count,
          q1_min, median_min, q3_min FROM d CROSS JOIN q GROUP BY ALL""",
    # windows
    "dedupe_latest": """SELECT track_id, track_name, duration_ms, explicit, snapshot_date FROM clean_tracks
        QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY extracted_at DESC, track_name, duration_ms, explicit,
          track_number, disc_number, album_id, artist_id, external_uri, snapshot_date) = 1""",
    "scd1_latest": """SELECT album_id, album_name, snapshot_date FROM sb
        QUALIFY row_number() OVER (PARTITION BY album_id ORDER BY snapshot_date DESC) = 1""",
    "release_gaps": "SELECT * FROM gaps",
    "growth_pct": f"""SELECT artist_id, snapshot_date, total_tracks, CASE WHEN p <> 0 THEN
        {rnd('CAST(total_tracks - p AS DOUBLE) / CAST(p AS DOUBLE) * 100.0::DOUBLE', 2)} END AS catalog_growth_pct
        FROM (SELECT *, lag(total_tracks) OVER (PARTITION BY artist_id ORDER BY snapshot_date) AS p FROM track_totals)""",
    "prev_value_lag": "SELECT artist_key, snapshot_date, total_tracks, prev_tracks FROM fa",
    "rank_per_snapshot": """SELECT artist_id, snapshot_date, recent_releases_12m, total_tracks,
        dense_rank() OVER (PARTITION BY snapshot_date ORDER BY recent_releases_12m DESC, total_tracks DESC)
          AS activity_rank FROM fact""",
    "rank_global": """SELECT artist_id, snapshot_date, median_release_cadence_days,
        dense_rank() OVER (ORDER BY median_release_cadence_days DESC NULLS LAST) AS cadence_rank FROM fact""",
    "peak_per_group": """SELECT artist_id, snapshot_date, release_month, count(*) AS n FROM sb
        WHERE release_month IS NOT NULL GROUP BY artist_id, snapshot_date, release_month
        QUALIFY row_number() OVER (PARTITION BY artist_id, snapshot_date ORDER BY count(*) DESC, release_month) = 1""",
    # sort, limit, set operations
    "ordered_topn": """SELECT snapshot_date, artist_name, total_tracks, recent_releases_12m, catalog_momentum_index FROM fa
        ORDER BY snapshot_date DESC, catalog_momentum_index DESC NULLS LAST, artist_name LIMIT 25""",
    "distinct_values": "SELECT DISTINCT artist_id, snapshot_date FROM st",
    "snapshot_dates": "SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM fact",
    "artist_list": "SELECT DISTINCT artist_name FROM da",
    "drop_null_sort": """SELECT artist_id, snapshot_date, median_release_cadence_days FROM fact
        WHERE median_release_cadence_days IS NOT NULL""",
    "incremental_merge_artists": merged("sa", "artist_id", "artist_id, artist_name, extracted_at", THIRD, FOURTH, True),
    "incremental_merge_albums": merged("sb", "album_id", "album_id, album_name, extracted_at", SECOND, LAST, False),
    "incremental_merge": merged(
        "st", "track_id", "track_id, track_name, duration_ms, extracted_at", SECOND, LAST, False
    ),
    "merge_snapshot": " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, {key} AS id, snapshot_date FROM ({merged(table, key, key, SECOND, LAST, wins)})"
        for entity, table, key, wins in (
            ("artists", "sa", "artist_id", True), ("albums", "sb", "album_id", False), ("tracks", "st", "track_id", False))
    ),
    "merge_snapshot_orphans": f"""SELECT {day(NEXT)} AS snapshot_date, count(*) AS total_rows,
        count(*) FILTER (WHERE album_id NOT IN (SELECT album_id FROM ({merged("sb", "album_id", "album_id", SECOND, LAST, False)}))) AS orphan_count
        FROM ({merged("st", "track_id", "track_id, album_id", SECOND, LAST, False)})""",
    "track_cache_reuse": f"""SELECT 'reused' AS action, track_id AS id, {day(NEXT)} AS snapshot_date FROM st
          WHERE snapshot_date = {day(SECOND)}
            AND album_id IN (SELECT album_id FROM sb WHERE snapshot_date = {day(THIRD)})
        UNION ALL SELECT 'fetch', album_id, snapshot_date FROM sb WHERE snapshot_date = {day(THIRD)}
            AND album_id NOT IN (SELECT album_id FROM st WHERE snapshot_date = {day(SECOND)})""",
    "dedupe_first_seen": """SELECT track_id, snapshot_date, track_name, duration_ms, extracted_at FROM clean_tracks
        WHERE duration_ms % 31 <> 0
        QUALIFY row_number() OVER (PARTITION BY track_id, snapshot_date ORDER BY extracted_at, track_name, duration_ms, explicit) = 1""",
    # ledger and idempotence
    "pending_snapshots": f"""SELECT DISTINCT snapshot_date FROM st
        WHERE snapshot_date NOT IN ({day(THIRD)}, {day(FIRST)})""",
    "commit_snapshot": f"""SELECT s.snapshot_date, s.row_count, l.job_name, l.status, l.metadata FROM
        (SELECT snapshot_date, count(*) AS row_count FROM st GROUP BY ALL) s JOIN (VALUES
          ({day(THIRD)}, 'nightly', 'SUCCESS', 'rows=1'), ({day(FIRST)}, 'nightly', 'SUCCESS', NULL),
          ({day(LAST)}, 'other', 'SUCCESS', NULL)) l(d, job_name, status, metadata) ON s.snapshot_date = l.d""",
    "verify_idempotent": f"""SELECT snapshot_date, count(*) AS rows_before, count(*) AS rows_after,
        CAST(0 AS BIGINT) AS duplicate_keys, CAST(0 AS BIGINT) AS orphans, CAST(0 AS BIGINT) AS differing_rows,
        true AS idempotent FROM fact WHERE snapshot_date = {day(LAST)} GROUP BY snapshot_date""",
    "row_differences": f"""SELECT track_id, track_name, duration_ms, CAST(sum(g) AS BIGINT) AS surplus FROM (
          SELECT track_id, track_name, duration_ms, 1 AS g FROM st WHERE snapshot_date = {day(LAST)}
          UNION ALL SELECT track_id, track_name, duration_ms, -1 FROM st WHERE snapshot_date = {day(FOURTH)})
        GROUP BY ALL HAVING sum(g) <> 0""",
    "contract_check": f"""SELECT * FROM (
        SELECT 'dim_date' AS table_name, count(*) AS row_count, CAST(1000 AS BIGINT) AS min_expected, 11 AS column_count,
          11 AS expected_columns, CASE WHEN count(*) >= 1000 THEN 'PASS' ELSE 'WARN' END AS status FROM ({_CALENDAR})
        UNION ALL SELECT 'dim_artist', count(*), 1, 6, 6, 'PASS' FROM da
        UNION ALL SELECT 'dim_album', count(*), 1000000000, 14, 14, 'WARN' FROM db
        UNION ALL SELECT 'dim_track', count(*), 1, 14, 2, 'WARN' FROM dt
        UNION ALL SELECT 'fact_artist_snapshot', count(*), 1, 11, 11, 'PASS' FROM fact
        UNION ALL SELECT 'mart_artist_activity', count(*), 1, 13, 13, 'PASS' FROM activity
        UNION ALL SELECT 'mart_artist_momentum', count(*), 1, 16, 16, 'PASS' FROM momentum)""",
    # data quality
    "dq_completeness": completeness("sa", "artists", 55),
    "dq_uniqueness": uniqueness("clean_tracks", "tracks", "track_id"),
    "dq_critical_nulls": nulls("clean_albums", "albums", ["album_id", "release_date", "image_url"]),
    "dq_referential": referential("sb", "sa", "artist_id", "albums", "artists"),
    "dq_value_ranges": counted("value_ranges", "st", "tracks", {
        "duration_ms": "duration_ms < 10000 OR duration_ms > 400000",
        "track_number": "track_number > 6",
        "allowed:disc_number": "disc_number <> 1",
        "allowed:track_number": "track_number NOT IN (1, 2, 3, 4)",
    }),
    "dq_completeness_empty": """SELECT 'completeness' AS rule, 'artists' AS entity, '' AS target, NULL::DATE AS snapshot_date,
        'FAIL' AS status, CAST(0 AS BIGINT) AS total_rows, CAST(1 AS BIGINT) AS violations, 0.0::DOUBLE AS rate_pct,
        'min_expected=1' AS detail FROM (SELECT count(*) FROM raw_artists WHERE snapshot_date IS NULL)""",
    "dq_report": REPORT,
    "quality_gate": GATE,
    "silver_gated_run": _GATED,
    "silver_gated_rerun": _GATED,
    "route_orphans_cascade": f"""SELECT track_id, snapshot_date, CASE WHEN {_KEPT_ALBUM} THEN 'kept' ELSE 'quarantined' END
        AS route FROM st c""",
    "dq_release_not_future": rule(
        "release_not_future", "albums", "release_date", "CASE WHEN f > 0 THEN 'FAIL' ELSE 'PASS' END", "n", "f",
        rnd("CAST(f AS DOUBLE) / CAST(n AS DOUBLE) * 100.0::DOUBLE", 2), "'release_date=' || f",
        "(SELECT snapshot_date, count(*) AS n, count(*) FILTER (release_date > snapshot_date) AS f FROM sb GROUP BY ALL)",
    ),
    # scalars and metrics
    "scalar_string": """SELECT album_id, snapshot_date, lower(album_name) AS lowered,
        CAST(length(album_name) AS INTEGER) AS name_length, substring(album_name, 1, 4) AS prefix,
        '<' || trim(album_name) || '>' AS wrapped, album_type IN ('album', 'single') AS is_main_format,
        md5(album_id) AS digest, CAST(release_date AS VARCHAR) AS release_text FROM sb""",
    "scalar_date": """SELECT album_id, snapshot_date, CAST(strftime(release_date, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(year(release_date) AS INTEGER) AS year, CAST(quarter(release_date) AS INTEGER) AS quarter,
        CAST(month(release_date) AS INTEGER) AS month, CAST(day(release_date) AS INTEGER) AS day_of_month,
        CAST(isodow(release_date) AS INTEGER) AS weekday, CAST(weekofyear(release_date) AS INTEGER) AS week,
        strftime(release_date, '%B') AS month_name, strftime(release_date, '%A') AS day_name,
        release_date - 365 AS year_before, CAST(snapshot_date - release_date AS INTEGER) AS age_days FROM sb""",
    "scalar_month_name": f"""SELECT album_id, snapshot_date, {month_name('release_month')} AS month_name,
        CAST(year(release_date) AS INTEGER) AS release_year FROM sb""",
    "scalar_math": f"""SELECT artist_id, snapshot_date, {pct('total_singles', 'total_albums + total_singles')} AS single_pct,
        {RATIO} AS ratio, total_tracks // 10 AS tens, least(total_albums, total_singles) AS smaller,
        greatest(total_albums, total_singles) AS larger, total_tracks % 7 AS remainder FROM fact""",
    "scalar_conditional": """SELECT artist_id, snapshot_date, coalesce(catalog_growth_pct, -1.0::DOUBLE) AS growth_or_minus_one,
        NULLIF(total_albums, 0) AS albums_or_null, catalog_growth_pct IS NULL AS is_first,
        CASE WHEN catalog_growth_pct > 0 THEN 'up' WHEN catalog_growth_pct < 0 THEN 'down' ELSE 'other' END AS direction,
        TRY_CAST(substring(artist_id, 2) AS INTEGER) AS artist_no FROM fact""",
    "scalar_array": """SELECT artist_id, CAST(len(years) AS INTEGER) AS span, CAST(unnest(years) AS INTEGER) AS active_year
        FROM (SELECT artist_id, generate_series(min(release_year), max(release_year)) AS years FROM sb
          WHERE release_year IS NOT NULL GROUP BY artist_id)""",
    "surrogate_keys": """SELECT track_id, snapshot_date, md5(track_id) AS track_key, md5(album_id) AS album_key,
        md5(artist_id) AS artist_key, CAST(strftime(snapshot_date, '%Y%m%d') AS INTEGER) AS date_key FROM st""",
    "score_recent": f"SELECT artist_id, snapshot_date, {S_RECENT} AS score FROM fact",
    "score_growth": f"SELECT artist_id, snapshot_date, {S_GROWTH} AS score FROM fact",
    "score_cadence": f"SELECT artist_id, snapshot_date, {rnd(S_CADENCE, 6)} AS score FROM fact",
    "momentum_index": f"SELECT artist_id, snapshot_date, {INDEX} AS momentum FROM fact",
    "momentum_pillars": """SELECT f.artist_id, m.snapshot_date, volume_score, growth_score, cadence_score
        FROM momentum m JOIN da f ON m.artist_key = f.artist_key""",
    "momentum_tier": f"SELECT artist_id, snapshot_date, {TIER} AS tier, {BADGE} AS badge FROM fact",
    "trajectory": f"SELECT artist_id, snapshot_date, {DELTA} AS delta, {DIRECTION} AS direction FROM fa",
    "strategy_by_ratio": f"SELECT artist_id, snapshot_date, {BY_RATIO} AS strategy FROM fact",
    "strategy_by_share": f"SELECT artist_id, snapshot_date, {BY_SHARE} AS strategy FROM fact",
    "activity_tier": f"SELECT artist_id, snapshot_date, {ACTIVITY} AS tier FROM fact",
    "growth_class": f"SELECT artist_id, snapshot_date, {BY_COUNT} AS by_count, {BY_PCT} AS by_pct FROM fa",
    "season_archetype": f"""SELECT album_id, snapshot_date, {ARCHETYPE} AS archetype FROM sb
        WHERE release_month IS NOT NULL""",
    # composite tables, marts, analyses, reads
    "silver_artists": "SELECT *, 'catalog-api' AS source FROM sa",
    "silver_albums": "SELECT *, 'catalog-api' AS source FROM sb",
    "silver_tracks": "SELECT *, 'catalog-api' AS source FROM st",
    "dim_date": _DIM_DATE,
    "dim_artist": "SELECT * FROM da",
    "dim_album": "SELECT * FROM db",
    "dim_track": "SELECT * FROM dt",
    "snapshot_base": "SELECT * FROM base",
    "snapshot_base_any_keys": "SELECT * FROM base",
    "fact_artist_snapshot": "SELECT * FROM fact",
    "fact_at_snapshot": f"SELECT * FROM fact WHERE snapshot_date = {day(LAST)}",
    "fact_increment": f"SELECT * FROM fact WHERE snapshot_date = {day(LAST)}",
    "build_gold": f"""SELECT 'dim_date' AS table_name, CAST(date_diff('day', DATE '1950-01-01', DATE '2030-12-31') + 1
          AS BIGINT) AS row_count, CAST(date_diff('day', DATE '1950-01-01', DATE '2030-12-31') + 1 AS BIGINT) AS last_written
        UNION ALL SELECT 'dim_artist', count(*), count(*) FROM da UNION ALL SELECT 'dim_album', count(*), count(*) FROM db
        UNION ALL SELECT 'dim_track', count(*), count(*) FROM dt
        UNION ALL SELECT 'fact_artist_snapshot', count(*), count(*) FILTER (snapshot_date = {day(LAST)}) FROM fact""",
    "build_gold_stepwise": "SELECT artist_id, snapshot_date, total_tracks, catalog_growth_pct, catalog_momentum_index FROM fact",
    "build_gold_backfill": "SELECT artist_id, snapshot_date, total_tracks, catalog_growth_pct, catalog_momentum_index FROM fact",
    "register_mart_views": """SELECT a.catalog_strategy, m.momentum_tier, g.growth_classification, m.snapshot_date,
        count(*) AS artists, CAST(sum(m.total_tracks) AS BIGINT) AS tracks FROM momentum m
        JOIN activity a ON m.artist_key = a.artist_key AND m.snapshot_date = a.snapshot_date
        JOIN growth g ON m.artist_key = g.artist_key AND m.snapshot_date = g.snapshot_date GROUP BY ALL""",
    "mart_artist_activity": "SELECT * FROM activity",
    "mart_artist_activity_latest": f"SELECT * FROM activity WHERE snapshot_date = {LATEST}",
    "mart_catalog_growth": "SELECT * FROM growth",
    "mart_release_seasonality": "SELECT * FROM seasonality",
    "mart_artist_momentum": "SELECT * FROM momentum",
    "mart_artist_momentum_latest": f"""SELECT * EXCLUDE (volume_score, growth_score, cadence_score) FROM momentum
        WHERE snapshot_date = {LATEST}""",
    "q1_top_active": f"""SELECT artist_name, recent_releases_12m, total_albums, total_singles, total_tracks,
        catalog_momentum_index, dense_rank() OVER (ORDER BY recent_releases_12m DESC) AS activity_rank
        FROM fa WHERE snapshot_date = {LATEST}""",
    "q2_format_mix": f"""SELECT artist_name, total_albums, total_singles, total_albums + total_singles AS total_catalog_releases,
        {pct('total_singles', 'total_albums + total_singles')} AS single_pct,
        {pct('total_albums', 'total_albums + total_singles')} AS album_pct, {RATIO} AS single_to_album_ratio,
        {BY_SHARE} AS catalog_strategy FROM fa WHERE snapshot_date = {LATEST}""",
    "q3_growth_velocity": f"""SELECT artist_name, snapshot_date, total_tracks, prev_tracks, catalog_growth_pct,
        {BY_PCT} AS growth_classification FROM fa""",
    "q4_net_tracks_added": f"""SELECT artist_name, snapshot_date, prev_tracks, total_tracks AS current_tracks,
        coalesce(total_tracks - prev_tracks, 0) AS net_tracks_added, catalog_growth_pct,
        dense_rank() OVER (ORDER BY coalesce(total_tracks - prev_tracks, 0) DESC, total_tracks DESC) AS expansion_rank
        FROM fa WHERE snapshot_date = {LATEST}""",
    "q5_monthly_distribution": """SELECT release_month, month_name, total_releases, studio_albums, singles, compilations,
        single_share_pct, volume_rank AS popularity_rank FROM seasonality""",
    "q6_peak_month": f"""SELECT artist_name, {month_name('release_month')} AS peak_release_month,
        releases_in_month AS peak_month_drops, lifetime_releases AS total_catalog_releases,
        {pct('releases_in_month', 'lifetime_releases', 1)} AS peak_month_concentration_pct
        FROM (SELECT * FROM artist_month WHERE release_month IS NOT NULL QUALIFY row_number() OVER (
          PARTITION BY artist_name ORDER BY releases_in_month DESC, release_month) = 1)""",
    "q7_momentum_leaderboard": f"""SELECT dense_rank() OVER (ORDER BY catalog_momentum_index DESC) AS momentum_rank,
        artist_name, catalog_momentum_index, total_tracks, recent_releases_12m, median_release_cadence_days,
        catalog_growth_pct, {TIER} AS momentum_tier FROM fa WHERE snapshot_date = {LATEST}""",
    "q8_momentum_delta": f"""SELECT artist_name, snapshot_date, prev_momentum, catalog_momentum_index AS current_momentum,
        {DELTA} AS momentum_delta, {DIRECTION} AS trajectory_direction FROM fa WHERE snapshot_date = {LATEST}""",
    "artist_activity_at": f"SELECT * FROM activity WHERE snapshot_date = {day(FOURTH)}",
    "artist_momentum_at": f"SELECT * FROM momentum WHERE snapshot_date = {day(FOURTH)}",
    "catalog_growth_all": "SELECT * FROM growth",
    "release_seasonality_all": "SELECT * FROM seasonality",
    "artist_trajectory": f"""SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, artist_name, total_tracks, total_albums,
        total_singles, catalog_momentum_index, recent_releases_12m, median_release_cadence_days FROM fa
        WHERE artist_name = '{SOME_ARTIST}'""",
    "artist_discography": f"""SELECT album_name, CAST(release_date AS VARCHAR) AS release_date, album_type, db.total_tracks,
        album_id, '{LINK}album/' || album_id AS album_url FROM db JOIN da ON db.artist_key = da.artist_key
        WHERE da.artist_name = '{SOME_ARTIST}'""",
    "duration_rows": _DURATIONS,
    "profile_snapshot": PROFILE_OUT,
    # streaming
    "incremental_landing_albums": f"SELECT {_BRONZE_ALBUMS} FROM raw_albums",
    "incremental_landing_artists": """SELECT trim(artist_id) AS artist_id, trim(artist_name) AS artist_name, external_uri, image_url,
        genre AS genres, extracted_at, snapshot_date, 'catalog-api' AS source FROM raw_artists""",
    "incremental_landing_tracks": """SELECT track_id, track_name, duration_ms, explicit, track_number, disc_number, album_id,
        artist_id, external_uri, extracted_at, snapshot_date, 'catalog-api' AS source FROM clean_tracks""",
    "landing_after_batch": f"SELECT {_BRONZE_ALBUMS} FROM raw_albums",
    # published layers, kept-up dimensions
    "dim_artist_increment": "SELECT * FROM da",
    "dim_album_increment": "SELECT * FROM db",
    "dim_track_increment": "SELECT * FROM dt",
    "dim_album_rerun": f"""SELECT md5(album_id) AS album_key, album_id, md5(artist_id) AS artist_key, artist_id, album_name, album_type,
        release_date, release_year, release_month, release_decade, release_date_precision, total_tracks, external_uri, image_url
        FROM sb WHERE snapshot_date <> {day(LAST)} OR album_type <> 'single'
        QUALIFY row_number() OVER (PARTITION BY album_id ORDER BY snapshot_date DESC) = 1""",
    "fact_published": "SELECT artist_id, snapshot_date, total_tracks, catalog_growth_pct, catalog_momentum_index FROM fact",
    "published_parts": """SELECT 'artists' AS table_name, snapshot_date, count(*) AS row_count FROM sa GROUP BY ALL
        UNION ALL SELECT 'albums', snapshot_date, count(*) FROM sb GROUP BY ALL UNION ALL SELECT 'tracks', snapshot_date, count(*) FROM st GROUP BY ALL
        UNION ALL SELECT 'dim_artist', NULL, count(*) FROM da UNION ALL SELECT 'dim_album', NULL, count(*) FROM db
        UNION ALL SELECT 'dim_track', NULL, count(*) FROM dt
        UNION ALL SELECT 'fact_artist_snapshot', snapshot_date, count(*) FROM fact GROUP BY ALL""",
    "published_versions": f"""SELECT CAST(v AS INTEGER) AS version, snapshot_date, count(*) AS row_count FROM fact JOIN (VALUES
        (1, {day(FIRST)}), (2, {day(THIRD)}), (3, {day(LAST)}), (4, {day(SECOND)}), (5, {day(FOURTH)})) a(n, s) ON snapshot_date = s
        JOIN (SELECT unnest(range(1, 6)) AS v) ON v >= n GROUP BY ALL""",
    "published_latest": f"SELECT * FROM fact WHERE snapshot_date = {LATEST}",
    "mart_from_published": "SELECT * FROM momentum",
    "published_pending": f"""SELECT 'artists' AS table_name, snapshot_date, count(*) AS row_count FROM sa
        WHERE snapshot_date IN ({day(SECOND)}, {day(FOURTH)}) GROUP BY ALL
        UNION ALL SELECT 'tracks', snapshot_date, count(*) FROM st WHERE snapshot_date IN ({day(SECOND)}, {day(FOURTH)}) GROUP BY ALL""",
    "silver_published_run": _GATED,
    # damaged and repeated landings
    "corrupt_array_split": " UNION ALL ".join(f"""SELECT '{entity}' AS entity, snapshot_date, CASE WHEN k % 29 = 0 THEN 'bad' ELSE 'good' END AS kind,
        count(*) AS n, count(*) AS stamped, count(DISTINCT external_uri) AS links
        FROM (SELECT *, CAST(regexp_extract(external_uri, ':([0-9]+)', 1) AS BIGINT) AS k FROM raw_{entity}) GROUP BY ALL"""
        for entity in ("artists", "albums", "tracks")),
    "corrupt_array_rows": """SELECT album_id, album_name, album_type, release_date, release_date_precision, total_tracks,
        artist_id, artist_name, external_uri, image_url, strftime(extracted_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS extracted_at,
        CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM raw_albums WHERE CAST(regexp_extract(external_uri, ':([0-9]+)', 1) AS BIGINT) % 29 <> 0""",
    "bronze_with_quarantine": " UNION ALL ".join(f"""SELECT snapshot_date, '{entity}' AS entity, CASE WHEN k % 29 = 0 THEN 'malformed_json' ELSE 'landed' END AS output,
        count(*) AS row_count FROM (SELECT *, CAST(regexp_extract(external_uri, ':([0-9]+)', 1) AS BIGINT) AS k FROM raw_{entity})
        WHERE snapshot_date = {day(FOURTH)} GROUP BY ALL""" for entity in ("artists", "albums", "tracks")),
    # intervals: the copied tables
    "interval_scan_artists": _with_base("sa", "artist_id", "artist_id, artist_name, extracted_at", THIRD, FOURTH, True),
    "interval_scan_albums": _with_base("sb", "album_id", "album_id, album_name, extracted_at", SECOND, LAST, False),
    "interval_scan_tracks": _with_base("st", "track_id", "track_id, track_name, duration_ms, extracted_at", SECOND, LAST, False),
    # ranks, bitmaps, fingerprints, sizes
    "rank_any_key": """SELECT track_id, snapshot_date, duration_ms, track_number,
        dense_rank() OVER (ORDER BY duration_ms DESC NULLS LAST, track_number DESC NULLS LAST) AS length_rank FROM st""",
    "rank_any_key_per_snapshot": """SELECT track_id, snapshot_date, duration_ms,
        dense_rank() OVER (PARTITION BY snapshot_date ORDER BY duration_ms DESC NULLS LAST) AS length_rank FROM st""",
    "presence_gaps": """SELECT a.artist_id, first_seen, last_seen, times_seen, coalesce(string_agg(CAST(s AS VARCHAR), ',' ORDER BY s), '') AS missing_in
        FROM (SELECT artist_id, min(snapshot_date) AS first_seen, max(snapshot_date) AS last_seen, count(DISTINCT snapshot_date) AS times_seen
              FROM sa GROUP BY artist_id) a
        LEFT JOIN (SELECT DISTINCT snapshot_date AS s FROM sa) d
          ON s > first_seen AND (a.artist_id, s) NOT IN (SELECT (artist_id, snapshot_date) FROM sa) GROUP BY ALL""",
    "parquet_footprint": " UNION ALL ".join(f"SELECT '{e}' AS entity, '{layer}' AS layer, count(*) AS row_count, true AS has_files FROM {t}"
        for e, layer, t in (("artists", "silver", "sa"), ("albums", "silver", "sb"), ("tracks", "silver", "st"),
                            ("artists", "gold", "da"), ("albums", "gold", "db"), ("tracks", "gold", "dt"))),
}
_FINAL |= {
    "differing_rows": _FINAL["row_differences"],
    **{f"landing_with_repeats_{e}": _FINAL[f"incremental_landing_{e}"] for e in ("artists", "albums", "tracks")},
}

STATEMENTS = {name: f"{BASE}\n{final}" for name, final in _FINAL.items()}
