"""Data-quality rules over every snapshot of a table at once.

A rule returns one row per snapshot in a common layout (:data:`RESULT_COLUMNS`),
so results are a table like any other and nothing is collected to the driver.

Rules only name the counters they need.  :func:`evaluate` stacks the counters of
all rules, sums them to one wide row per snapshot and reads every verdict off that
row.  Row-level counters combine on the map side; only the uniqueness rule and the
foreign keys shuffle anything, and that is nothing but keys.  A snapshot that one
table has and another lacks counts as zero rows there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat import model as M
from snapcat.model import SNAPSHOT
from snapcat.operators.joins import orphan_counts

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
RESULT_COLUMNS = (
    "rule", "entity", "target", SNAPSHOT, "status", "total_rows", "violations", "rate_pct", "detail",
)


def blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")


def out_of_bounds(name: str, bounds: tuple) -> Column:
    """Non-null value outside inclusive bounds; None leaves a side open."""
    low, high = bounds
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(name) < low)
    if high is not None:
        outside = outside | (F.col(name) > high)
    return F.col(name).isNotNull() & outside


def not_allowed(name: str, values: Sequence) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).isin(*values)


def expected_snapshots(spark: SparkSession, snapshots: Sequence[str]) -> DataFrame:
    """Snapshots a run must deliver, so one that no table has shows up too."""
    return spark.createDataFrame([(s,) for s in snapshots], "d string").select(F.to_date("d").alias(SNAPSHOT))


def with_snapshot(df: DataFrame) -> DataFrame:
    """A table without a snapshot column is one snapshot without a date."""
    return df if SNAPSHOT in df.columns else df.withColumn(SNAPSHOT, F.lit(None).cast("date"))


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100.0, 2)).otherwise(F.lit(0.0))


def _pass_or_fail(violations: Column) -> Column:
    return F.when(violations > 0, F.lit(FAIL)).otherwise(F.lit(PASS))


def _detail(counts: Mapping[str, Column]) -> Column:
    """``name=count`` pairs in declaration order."""
    return F.concat_ws(",", *(F.concat(F.lit(f"{name}="), count.cast("string")) for name, count in counts.items()))


class Rules:
    """Rules of one subject; counters carry a prefix so that many fit in a row."""

    def __init__(self, entity: str) -> None:
        self.entity = entity
        self.prefix = ""

    def counters(self) -> list[DataFrame]:
        """Partial results with one row per snapshot."""
        raise NotImplementedError

    def records(self) -> list[Column]:
        """One struct per rule, computed from the summed counters."""
        raise NotImplementedError

    def value(self, name: str) -> Column:
        return F.col(self.prefix + name)

    def record(
        self, rule: str, target: str, status: Column, violations: Column, detail: Column, rate: Column | None = None
    ) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(self.entity).alias("entity"),
            F.lit(target).alias("target"),
            F.col(SNAPSHOT).alias(SNAPSHOT),
            status.alias("status"),
            self.value("total_rows").alias("total_rows"),
            violations.cast("bigint").alias("violations"),
            (F.lit(0.0) if rate is None else rate).alias("rate_pct"),
            detail.alias("detail"),
        )


class RowRules(Rules):
    """Completeness, uniqueness, blanks and value ranges of one table.

    Only what is asked for is counted: uniqueness needs ``keys``, blanks need
    ``critical``, ranges need ``bounds`` or ``allowed``.  A column with both kinds
    of range rule reports both.
    """

    def __init__(
        self,
        entity: str,
        df: DataFrame,
        min_expected: int | None = None,
        keys: Sequence[str] = (),
        critical: Sequence[str] = (),
        bounds: Mapping[str, tuple] | None = None,
        allowed: Mapping[str, Sequence] | None = None,
    ) -> None:
        super().__init__(entity)
        self.df, self.min_expected, self.keys = with_snapshot(df), min_expected, tuple(keys)
        self.blanks = {name: blank(name) for name in critical}
        self.ranges = {name: out_of_bounds(name, b) for name, b in (bounds or {}).items()}
        self.ranges |= {f"allowed:{name}": not_allowed(name, v) for name, v in (allowed or {}).items()}

    def _violations(self) -> dict[str, Column]:
        kinds = (("blank", self.blanks), ("range", self.ranges))
        return {f"{kind}_{i}": cond for kind, conds in kinds for i, cond in enumerate(conds.values())}

    def counters(self) -> list[DataFrame]:
        found = {"total_rows": F.count(F.lit(1))} | {name: _count(cond) for name, cond in self._violations().items()}
        parts = [self.df.groupBy(SNAPSHOT).agg(*(c.alias(name) for name, c in found.items()))]
        if self.keys:
            # Counters stay on the map side; what is shuffled is the keys alone, each once per task.
            keys = self.df.select(SNAPSHOT, *(k for k in self.keys if k != SNAPSHOT)).distinct()
            parts.append(keys.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("distinct_keys")))
        return parts

    def records(self) -> list[Column]:
        out = []
        rows = self.value("total_rows")
        if self.min_expected is not None:
            missing = F.greatest(F.lit(self.min_expected) - rows, F.lit(0))
            detail = _detail({"min_expected": F.lit(self.min_expected)})
            out.append(self.record("completeness", "", _pass_or_fail(missing), missing, detail))
        if self.keys:
            distinct = self.value("distinct_keys")
            repeated = rows - distinct
            detail = _detail({"distinct_keys": distinct})
            out.append(
                self.record(
                    "uniqueness", ",".join(self.keys), _pass_or_fail(repeated), repeated, detail, _rate(repeated, rows)
                )
            )
        for rule, kind, conds in (("critical_nulls", "blank", self.blanks), ("value_ranges", "range", self.ranges)):
            if conds:
                counts = {name: self.value(f"{kind}_{i}") for i, name in enumerate(conds)}
                total = reduce(Column.__add__, counts.values())
                out.append(self.record(rule, ",".join(counts), _pass_or_fail(total), total, _detail(counts)))
        return out


class ReferenceRule(Rules):
    """Foreign key: PASS without orphans, WARN up to the threshold, FAIL above it."""

    def __init__(
        self,
        child_entity: str,
        child: DataFrame,
        parent_entity: str,
        parent: DataFrame,
        foreign_key: str,
        parent_key: str | None = None,
        max_orphan_pct: float = M.MAX_ORPHAN_PCT,
    ) -> None:
        super().__init__(child_entity)
        self.target = f"{foreign_key}->{parent_entity}"
        self.counts = orphan_counts(with_snapshot(child), with_snapshot(parent), foreign_key, parent_key, [SNAPSHOT])
        self.max_orphan_pct = float(max_orphan_pct)

    def counters(self) -> list[DataFrame]:
        return [self.counts]

    def records(self) -> list[Column]:
        orphans = self.value("orphan_count")
        rate = _rate(orphans, self.value("total_rows"))
        status = (
            F.when(orphans == 0, F.lit(PASS)).when(rate <= self.max_orphan_pct, F.lit(WARN)).otherwise(F.lit(FAIL))
        )
        detail = _detail({"threshold_pct": F.lit(self.max_orphan_pct)})
        return [self.record("referential_integrity", self.target, status, orphans, detail, rate)]


class FutureReleaseRule(Rules):
    """FAIL on releases dated after the snapshot that reports them."""

    def __init__(self, albums: DataFrame) -> None:
        super().__init__("albums")
        self.albums = with_snapshot(albums)

    def counters(self) -> list[DataFrame]:
        future = _count(F.col("release_date") > F.col(SNAPSHOT)).alias("future_rows")
        return [self.albums.groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("total_rows"), future)]

    def records(self) -> list[Column]:
        found = self.value("future_rows")
        detail = _detail({"release_date": found})
        rate = _rate(found, self.value("total_rows"))
        return [self.record("release_not_future", "release_date", _pass_or_fail(found), found, detail, rate)]


def evaluate(rules: Sequence[Rules], expected: DataFrame | None = None) -> DataFrame:
    """Results of all rules for every snapshot any table has, or that is expected.

    If there is none at all, the results are those of an empty table, with a NULL
    snapshot.  The stacked parts hold one row per snapshot each.
    """
    parts, names = [], []
    for i, rule in enumerate(rules):
        rule.prefix = f"r{i}_"
        for part in rule.counters():
            counters = [c for c in part.columns if c != SNAPSHOT]
            # A number and one array for each part: the plan of a stack with a column per counter takes longer than the work.
            parts.append(part.select(SNAPSHOT, F.lit(len(names)).alias("__part"), F.array(*counters).alias("__counters")))
            names.append([rule.prefix + c for c in counters])
    none = F.array().cast("array<bigint>").alias("__counters")
    if expected is not None:
        parts.append(expected.select(SNAPSHOT, F.lit(-1).alias("__part"), none))
    parts.append(parts[0].sparkSession.range(1).select(F.lit(None).cast("date").alias(SNAPSHOT), F.lit(None).cast("int").alias("__part"), none))
    # A part has one row per snapshot.
    totals = reduce(DataFrame.unionByName, parts).groupBy(SNAPSHOT).agg(
        F.count("__part").alias("__seen"),
        *(F.max(F.when(F.col("__part") == i, F.col("__counters"))).alias(f"__{i}") for i in range(len(names))),
    )
    # One row per snapshot meets here.
    totals = totals.withColumn("__any", F.sum("__seen").over(Window.partitionBy())).filter((F.col("__seen") > 0) | (F.col("__any") == 0))
    totals = totals.select(SNAPSHOT, *(
        F.coalesce(F.get(f"__{i}", F.lit(k)), F.lit(0)).alias(name) for i, part in enumerate(names) for k, name in enumerate(part)))
    return totals.select(F.inline(F.array(*(record for rule in rules for record in rule.records()))))


def dq_completeness(
    df: DataFrame, entity: str, min_expected: int = 1, expected: DataFrame | None = None
) -> DataFrame:
    """FAIL below a minimum number of rows."""
    return evaluate([RowRules(entity, df, min_expected)], expected)


def dq_uniqueness(df: DataFrame, entity: str, keys: Sequence[str], expected: DataFrame | None = None) -> DataFrame:
    """FAIL on repeated keys; NULL counts as one key."""
    return evaluate([RowRules(entity, df, keys=keys)], expected)


def dq_critical_nulls(
    df: DataFrame, entity: str, columns: Sequence[str], expected: DataFrame | None = None
) -> DataFrame:
    """FAIL on NULL or blank values in essential columns."""
    return evaluate([RowRules(entity, df, critical=columns)], expected)


def dq_value_ranges(
    df: DataFrame,
    entity: str,
    bounds: Mapping[str, tuple] | None = None,
    allowed: Mapping[str, Sequence] | None = None,
    expected: DataFrame | None = None,
) -> DataFrame:
    """FAIL on values outside inclusive bounds or allowed sets; NULL passes."""
    return evaluate([RowRules(entity, df, bounds=bounds, allowed=allowed)], expected)


def dq_referential(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: str,
    child_entity: str,
    parent_entity: str,
    parent_key: str | None = None,
    max_orphan_pct: float = M.MAX_ORPHAN_PCT,
    expected: DataFrame | None = None,
) -> DataFrame:
    """PASS without orphans, WARN up to the threshold, FAIL above it."""
    rule = ReferenceRule(child_entity, child, parent_entity, parent, foreign_key, parent_key, max_orphan_pct)
    return evaluate([rule], expected)


def dq_release_not_future(albums: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """FAIL on releases dated after the snapshot that reports them."""
    return evaluate([FutureReleaseRule(albums)], expected)


def quality_gate(
    artists: DataFrame,
    albums: DataFrame,
    tracks: DataFrame,
    max_orphan_pct: float = M.MAX_ORPHAN_PCT,
    track_bounds: Mapping[str, tuple] = M.TRACK_BOUNDS,
    expected: DataFrame | None = None,
) -> DataFrame:
    """The 13 standard checks, for every snapshot of the three tables."""
    tables = {"artists": artists, "albums": albums, "tracks": tracks}
    rules: list[Rules] = [
        RowRules(
            entity, df, 1, [M.ENTITY_KEY[entity]], M.CRITICAL_COLUMNS[entity],
            track_bounds if entity == "tracks" else None,
        )
        for entity, df in tables.items()
    ]
    # Each foreign key is reduced by itself: another narrow scan costs less than shuffling the pairs of both.
    rules += [
        ReferenceRule(child, tables[child], parent, tables[parent], key, max_orphan_pct=max_orphan_pct)
        for child, parent, key in M.FOREIGN_KEYS
    ]
    return evaluate(rules, expected)


def dq_report(results: DataFrame) -> DataFrame:
    """Summary per snapshot; FAIL outweighs WARN, WARN outweighs PASS."""

    def having(status: str) -> Column:
        return F.count(F.when(F.col("status") == status, 1))

    total = F.count(F.lit(1))
    overall = (
        F.when(having(FAIL) > 0, F.lit(FAIL)).when(having(WARN) > 0, F.lit(WARN)).otherwise(F.lit(PASS))
    )
    return results.groupBy(SNAPSHOT).agg(
        overall.alias("overall_status"),
        total.alias("total_checks"),
        having(PASS).alias("passed"),
        having(WARN).alias("warnings"),
        having(FAIL).alias("failed"),
        F.round(having(PASS) / total * 100.0, 2).alias("success_rate_pct"),
    )


def quarantine(df: DataFrame, rule: str, reason: str, snapshot: str | None = None) -> DataFrame:
    """Rejected rows with their audit stamp.

    ``snapshot`` is the day of the run; without it the rows' own snapshot stays (NULL if they have none).
    """
    stamped = with_snapshot(df) if snapshot is None else df.withColumn(SNAPSHOT, F.to_date(F.lit(snapshot)))
    return stamped.withColumns({
        "dq_rule": F.lit(rule),
        "dq_reason": F.lit(reason),
        "quarantined_at": F.current_timestamp(),
    })
