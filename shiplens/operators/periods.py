"""Look-back windows and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.functions.stats import rounded


def latest_date(df: DataFrame, ts: str) -> Column:
    """Newest date of a column as a scalar subquery: the default ``as_of``."""
    return df.select(F.max(F.to_date(ts))).scalar()


def _as_of(df: DataFrame, ts: str, as_of) -> Column:
    if as_of is None:
        return latest_date(df, ts)
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(as_of))


def in_windows(
    df: DataFrame, ts: str, windows, as_of=None, name: str = "window_days"
) -> DataFrame:
    """One row per look-back window an event falls in (``date >= as_of - window``).

    The windows are a literal array exploded per row, so all of them are served by one pass
    with no join; rows older than the longest window are cut at the scan.
    """
    end = _as_of(df, ts, as_of)
    day = F.to_date(ts)
    kept = df.where(day >= F.date_sub(end, max(windows))).withColumn("_age", F.datediff(end, day))
    lengths = F.array(*[F.lit(int(w)) for w in sorted(windows)])
    return kept.withColumn(name, F.explode(lengths)).where(F.col("_age") <= F.col(name)).drop("_age")


def windowed_activity(
    events: DataFrame,
    entity: str,
    event_id: str,
    actor: str,
    ts: str,
    windows=(30, 90, 365),
    as_of=None,
) -> DataFrame:
    """Distinct events, distinct actors and last date per entity and look-back window."""
    rows = in_windows(events.select(entity, event_id, actor, ts), ts, windows, as_of)
    return rows.groupBy(entity, "window_days").agg(
        F.count_distinct(event_id).alias("commit_count"),
        F.count_distinct(actor).alias("unique_authors"),
        F.max(F.to_date(ts)).alias("last_commit_date"),
    )


def windowed_defects(
    issues: DataFrame,
    bridge: DataFrame,
    component: str,
    module: str,
    created: str,
    source: str,
    severity: str,
    windows=(30, 90, 365),
    as_of=None,
    customer="customer",
    internal="internal",
    default_severity: float = 3.0,
    weight: str | None = None,
) -> DataFrame:
    """Defect counts and a severity score in [0, 1] per module and look-back window.

    An issue counts once in every module of its component, as in the source data model;
    ``weight`` names a bridge column to share it out instead.
    """
    sev = F.when(
        (F.col(source) == internal) & F.col(severity).isNull(), F.lit(default_severity)
    ).otherwise(F.col(severity).cast("double"))
    base = issues.select(component, created, source, sev.alias("_sev"))
    end = _as_of(issues, created, as_of)
    mapped = bridge.select(component, module, *([weight] if weight else [])).distinct()
    one = F.lit(1)

    def count_of(value):
        return F.sum(F.when(F.col(source) == value, one).otherwise(0))

    # Added up per component first: the bridge then repeats totals, not issues.
    totals = in_windows(base, created, windows, end).groupBy(component, "window_days").agg(
        F.count(one).alias("_n"),
        count_of(customer).alias("_customer"),
        count_of(internal).alias("_internal"),
        F.sum("_sev").alias("_sev"),
    )
    w = F.col(weight) if weight else one
    n = F.sum(F.col("_n") * w)
    return totals.join(mapped, component).groupBy(module, "window_days").agg(
        n.alias("bug_count"),
        F.sum(F.col("_customer") * w).alias("customer_reported_count"),
        F.sum(F.col("_internal") * w).alias("internal_count"),
        rounded(F.coalesce(F.sum(F.col("_sev") * w), F.lit(0.0)) / (n * 5), 4).alias(
            "severity_weighted_score"
        ),
    )


def resolve_names(
    df: DataFrame, raw: str, known: DataFrame, name: str, aliases: dict[str, str], out: str
) -> DataFrame:
    """Full name where the dimension knows it, else the part before ``>``, then aliases."""
    full = F.trim(F.col(raw))
    known_names = known.select(F.col(name).alias("_known")).distinct()
    joined = df.withColumn("_full", full).join(known_names, F.col("_full") == F.col("_known"), "left")
    short = F.trim(F.regexp_replace(F.col(raw), r">.*", ""))
    picked = F.when(F.col("_known").isNotNull(), F.col("_full")).otherwise(short)
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in sorted(aliases.items()) for x in kv])
        picked = F.coalesce(F.try_element_at(table, picked), picked)
    return joined.withColumn(out, picked).drop("_full", "_known")


def period_days(periods: DataFrame, label: str, start: str, end: str) -> DataFrame:
    """Closed periods laid out one row per day; the earliest-starting period owns a day.

    This turns the range join of events with periods into an equi-join on the date. The
    table has one row per calendar day covered, whatever the number of events.
    """
    days = periods.select(
        label, F.to_date(start).alias("_s"), F.to_date(end).alias("_e")
    ).where(F.col("_s") <= F.col("_e"))
    return (
        days.select(label, "_s", F.explode(F.sequence("_s", "_e")).alias("_day"))
        .groupBy("_day")
        .agg(F.min_by(label, F.struct("_s", label)).alias(label))
    )


def assign_period(
    events: DataFrame,
    date: Column,
    periods: DataFrame,
    label: str,
    start: str,
    end: str,
    explicit: Column | None = None,
    first_label: str | None = None,
    out: str = "quarter",
) -> DataFrame:
    """Explicit label where given, else the period the date falls in.

    Rows with neither, or with a label before ``first_label``, are dropped; a given label
    that is too old is not replaced by a date lookup.
    """
    days = period_days(periods, label, start, end).withColumnRenamed(label, "_found")
    joined = events.withColumn("_day", F.to_date(date)).join(days, "_day", "left")
    chosen = F.col("_found") if explicit is None else F.coalesce(explicit, F.col("_found"))
    kept = joined.withColumn(out, chosen).drop("_day", "_found").where(F.col(out).isNotNull())
    if first_label is not None:
        kept = kept.where(F.col(out) >= first_label)
    return kept


def uncovered_days(periods: DataFrame, label: str, start: str, end: str) -> DataFrame:
    """Days between the first start and the last end that no period holds."""
    spans = periods.agg(
        F.min(F.to_date(start)).alias("_a"), F.max(F.to_date(end)).alias("_b")
    )
    every = spans.select(F.explode(F.sequence("_a", "_b")).alias("_day"))
    return every.join(period_days(periods, label, start, end), "_day", "left_anti").select(
        F.col("_day").alias("day")
    )


def months_in_field(release_date: Column, as_of) -> Column:
    """Whole months (30 days) since release, 3 where there is no date yet."""
    end = as_of if isinstance(as_of, Column) else F.to_date(F.lit(as_of))
    return F.coalesce(rounded(F.datediff(end, release_date) / 30.0).cast("int"), F.lit(3))


def year_quarter(date: Column) -> Column:
    """``2024.Q1`` style label, ordered as a string."""
    return F.concat(F.year(date).cast("string"), F.lit(".Q"), F.quarter(date).cast("string"))


def week_start(ts: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", ts))


def period_counts(
    issues: DataFrame,
    components: DataFrame,
    component_text: Column,
    kind: str,
    quarter: str,
    component_name: str = "component_name",
    component_id: str = "component_id",
    blocker: str | None = None,
    kinds=("customer", "internal", "story"),
) -> DataFrame:
    """Counts per component and period, one column per issue kind plus blockers."""
    from shiplens.functions.paths import component_names

    rows = issues.withColumn(component_name, F.explode(component_names(component_text)))
    columns = [f"{k}_count" for k in kinds]
    aggs = [F.sum(F.when(F.col(kind) == k, 1).otherwise(0)).alias(c) for k, c in zip(kinds, columns)]
    if blocker:
        flagged = F.coalesce(F.col(blocker), F.lit(False)) & (F.col(kind) == "internal")
        aggs.append(F.sum(F.when(flagged, 1).otherwise(0)).alias("blocker_count"))
        columns.append("blocker_count")
    # Counted by name first; names that share an id are added up after the lookup.
    counts = rows.groupBy(component_name, quarter).agg(*aggs)
    matched = counts.join(components.select(component_name, component_id), component_name)
    return matched.groupBy(component_id, quarter).agg(*[F.sum(c).alias(c) for c in columns])


def unmatched_components(
    issues: DataFrame,
    components: DataFrame,
    component_text: Column,
    component_name: str = "component_name",
) -> DataFrame:
    """Parsed component names the dimension does not know, with their row counts."""
    from shiplens.functions.paths import component_names

    rows = issues.select(F.explode(component_names(component_text)).alias(component_name))
    counts = rows.groupBy(component_name).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(components.select(component_name), component_name, "left_anti")


def tag_ranges(tags: DataFrame, series: str, order: str, tag: str) -> DataFrame:
    """``tag_range`` of each tag: from the one before it in its series; null for a series' first.

    A gap in the numbering is skipped, as the range starts at the tag that exists.
    """
    before = F.lag(tag).over(Window.partitionBy(series).orderBy(order))
    return tags.withColumn("tag_range", F.concat(before, F.lit("..."), F.col(tag)))


def rolled_up(rows: DataFrame, levels: list[str], measures: dict[str, Column]) -> DataFrame:
    """``measures`` per group of all levels, of all but the last, and so on up to the total.

    ``level`` is the number of levels a row keeps, so a null name is told from a total.
    """
    kept = F.lit(len(levels))
    for c in levels:
        kept = kept - F.grouping(c)
    return rows.rollup(*levels).agg(kept.cast("int").alias("level"), *[m.alias(n) for n, m in measures.items()])


def in_date_order(rows: DataFrame, group: list[str], date: str, ties: list[str]) -> DataFrame:
    """``place`` by date within each group, rows without a date last, and ``sort_date``, theirs the far date."""
    order = Window.partitionBy(*group).orderBy(F.col(date).asc_nulls_last(), *ties)
    far = F.lit("9999-12-31").cast("date")
    return rows.withColumns({"sort_date": F.coalesce(F.col(date).cast("date"), far), "place": F.row_number().over(order)})
