"""Regression triage: status dedup, comparison of two builds, rules, groups, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.paths import culprit_file, name_fragments, path_suffixes
from shiplens.functions.stats import mode_per_group, ratio, rounded
from shiplens.lineage import cut_lineage, tasks_for
from shiplens.operators.bridge import top_per_group
from shiplens.operators.containment import contained

# Statuses from worst to best, and those that make a regression.
STATUS_RANK = {"FAILED": 4, "BLOCKED": 3, "UNTESTED": 2, "PASSED": 1}
REGRESSED = ("FAILED", "BLOCKED", "UNTESTED")
# Error patterns that need no reading, first label wins, case ignored.
ERROR_RULES = (
    ("BUILD_FAILURE", ("The build failed prior to running the test",)),
    ("ENV_CHROME", ("chrome=100.0", "Session info: chrome=1")),
    ("ENV_DEPENDENCY", ("org.tensorflow", "Downloaded https://repository-cdn")),
    ("ENV_DATE", (r"data-startdate,'11/\d{2}/20\d{2}'",)),
    ("ENV_SETUP", ("TEST_SETUP_ERROR",)),
)
# Changed files that shape many pages at once.
SHARED_UI_PATTERNS = (
    r"/resources/.+\.(jsp|jspf|html)$",
    r"/resources/.+/(nav|layout|header|panel|chrome|theme)/.+\.(jsp|tsx|ts|jsx|js|scss|css)$",
    r"/application-list-taglib/.+/resources/.+",
    r"/frontend-taglib/.+/resources/.+",
    r"/frontend-taglib-clay/.+/resources/.+",
    r"/frontend-js-web/.+/resources/.+\.(tsx|ts|jsx|js)$",
    r"/product-navigation/.+/resources/.+\.(tsx|ts|jsx|js|jsp|scss|css)$",
    r"/site-navigation/.+/resources/.+\.(tsx|ts|jsx|js|jsp|scss|css)$",
    r"/nav-menu/.+/resources/.+",
    r"/theme/.+\.(jsp|scss|css|js|tsx)$",
    r"/layout-admin-web/.+/resources/.+\.(jsp|tsx|scss|css)$",
)
SHARED_UI_MAX_LINES = 600


def status_rank(status: Column) -> Column:
    rank = F.lit(0)
    for name, r in STATUS_RANK.items():
        rank = F.when(status == name, r).otherwise(rank)
    return rank


def one_per_case(
    results: DataFrame, keys: list[str], status: str, tiebreak: list[str], pass_wins: bool
) -> DataFrame:
    """One row per case over its retries: worst status, or PASSED if ``pass_wins``.

    An aggregate, not a window: it combines before the shuffle and never sorts a case.
    """
    rest = [c for c in results.columns if c not in keys]
    rank = status_rank(F.col(status))
    order = [(F.col(status) == "PASSED").cast("int")] if pass_wins else []
    order += [F.coalesce(rank, F.lit(0)), *[F.col(t) for t in tiebreak]]
    order = [F.coalesce(order[0], F.lit(0)), *order[1:]] if pass_wins else order
    return (
        results.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("_r"))
        .select(*keys, "_r.*")
    )


def join_keys(target: DataFrame) -> list[str]:
    """Case id where the target side has any, else case and component name."""
    has_ids = target.where(F.col("case_id").isNotNull()).limit(1).count() > 0
    return ["case_id"] if has_ids else ["case_name", "component_name"]


def regressions(
    baseline: DataFrame,
    target: DataFrame,
    keys: list[str],
    status: str = "status",
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Cases that passed in the baseline and fail, block or stay untested in the target.

    Any passing retry makes a baseline pass; the worst retry stands for the target.
    Columns other than the keys carry ``_a`` and ``_b``.
    """
    tiebreak = tiebreak or []
    a = one_per_case(baseline, keys, status, tiebreak, pass_wins=True)
    b = one_per_case(target, keys, status, tiebreak, pass_wins=False)

    def suffix(df, s):
        return df.select(*keys, *[F.col(c).alias(c + s) for c in df.columns if c not in keys])

    a = suffix(a.where(F.col(status) == "PASSED"), "_a")
    b = suffix(b.where(F.col(status).isin(*REGRESSED)), "_b")
    return a.join(b, keys)


def error_label(error: Column, rules=ERROR_RULES) -> Column:
    """First rule whose pattern is in the text; NO_ERROR if empty; null if none fits."""
    label = F.when(error.isNull() | (error == ""), F.lit("NO_ERROR"))
    for name, patterns in rules:
        hit = error.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns))
        label = label.when(hit, F.lit(name))
    return label


def pre_classify(
    cases: DataFrame,
    case_id: str,
    error: str,
    flaky: str,
    rules=ERROR_RULES,
    teams: DataFrame | None = None,
    component: str = "component_name",
    team: str = "team_name",
) -> DataFrame:
    """Rule label, owning team and bucket (flaky, auto, to_classify), one row per case."""
    rest = [c for c in cases.columns if c != case_id]
    out = (
        cases.groupBy(case_id)
        .agg(F.min(F.struct(*rest)).alias("_r"))
        .select(case_id, "_r.*")
        .withColumn("pre_classification", error_label(F.col(error), rules))
    )
    if teams is not None:
        known = teams.where(F.col(team).isNotNull()).select(component, F.col(team).alias("_team"))
        out = out.join(known, component, "left")
        given = F.col(team) if team in out.columns else F.lit(None).cast("string")
        out = out.withColumn(team, F.coalesce("_team", given)).drop("_team")
    flag = F.coalesce(F.col(flaky), F.lit(False))
    return out.withColumn(
        "bucket",
        F.when(flag, "flaky")
        .when(F.col("pre_classification").isNotNull(), "auto")
        .otherwise("to_classify"),
    )


def group_key(group: str, case_id: str) -> Column:
    """Group id, or a key of its own for each case without one."""
    linked = F.col(group).isNotNull() & (F.col(group) != 0)
    return F.when(linked, F.concat(F.lit("g"), F.col(group).cast("string"))).otherwise(
        F.concat(F.lit("c"), F.col(case_id).cast("string"))
    )


def failure_groups(
    cases: DataFrame,
    group: str,
    case_id: str,
    error: str,
    component: str,
    issue: str,
    flaky: str,
    status: str,
    label: str = "pre_classification",
) -> DataFrame:
    """One row per failure group: size, shared error, flags, bucket, status counts.

    Members stay in long form (``group_members``): a group may hold any number of cases.
    """
    flag = F.coalesce(F.col(flaky), F.lit(False))
    rows = cases.withColumn("group_key", group_key(group, case_id))
    text = F.when(F.col(error) != "", F.col(error))
    stat = F.coalesce(F.col(status), F.lit("FAILED"))
    summary = rows.groupBy("group_key").agg(
        F.max(F.when(F.col(group) != 0, F.col(group))).alias(group),
        F.count(F.lit(1)).alias("case_count"),
        F.count_distinct(text).alias("n_errors"),
        F.count_distinct(F.when(F.col(component) != "", F.col(component))).alias("n_components"),
        F.count_distinct(F.when(F.col(issue) != "", F.col(issue))).alias("n_linked_issues"),
        F.array_join(F.array_sort(F.collect_set(label)), "|").alias("pre_classifications"),
        F.bool_or(flag).alias("any_known_flaky"),
        F.bool_and(flag).alias("all_known_flaky"),
        F.bool_and(F.col(label).isNotNull()).alias("all_pre_classified"),
        *[
            F.sum(F.when(stat == s, 1).otherwise(0)).alias(f"n_{s.lower()}") for s in REGRESSED
        ],
    )
    shared = mode_per_group(
        rows.withColumn("_text", text), ["group_key"], "_text", "shared_error"
    )
    return (
        summary.join(shared, "group_key", "left")
        .withColumn("shared_error", F.coalesce("shared_error", F.lit("")))
        .withColumn(
            "bucket",
            F.when(F.col("all_known_flaky"), "flaky-only")
            .when(F.col("all_pre_classified"), "auto-only")
            .otherwise("classifiable"),
        )
    )


def group_members(cases: DataFrame, group: str, case_id: str) -> DataFrame:
    return cases.select(group_key(group, case_id).alias("group_key"), case_id)


def fan_out_verdicts(
    cases: DataFrame,
    verdicts: DataFrame,
    keys: list[str],
    flaky: str,
    label: str = "pre_classification",
    strategy: str = "",
) -> DataFrame:
    """A verdict on every case: rule label first, then the verdict, else NEEDS_REVIEW.

    Flaky cases are dropped. ``keys`` is the case id, or the group key to give one verdict
    to all members.
    """
    cols = ["classification", "confidence", "reason", "culprit_file", "specific_change"]
    given = verdicts.select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    rows = cases.where(~F.coalesce(F.col(flaky), F.lit(False))).join(given, keys, "left")
    auto, found = F.col(label).isNotNull(), F.col("_classification").isNotNull()
    marker = F.when(
        F.col("_culprit_file") != "",
        F.concat(F.lit("  [culprit_file="), F.col("_culprit_file"), F.lit("]")),
    ).otherwise("")
    return rows.withColumns(
        {
            "classification": F.when(auto, "AUTO_CLASSIFIED").otherwise(
                F.coalesce("_classification", F.lit("NEEDS_REVIEW"))
            ),
            "specific_change": F.when(~auto, F.col("_specific_change")),
            "reason": F.when(auto, F.concat(F.lit("pre_classification="), F.col(label)))
            .when(found, F.concat(F.col("_reason"), marker))
            .otherwise("No verdict given, defaulted to NEEDS_REVIEW"),
            "match_strategy": F.when(auto, "auto")
            .when(found, F.concat(F.lit(f"{strategy}confidence="), F.col("_confidence")))
            .otherwise("missing"),
        }
    ).drop(*[f"_{c}" for c in cols])


def members_of_verdicts(verdicts: DataFrame, members: DataFrame, group: str, case_ids: str):
    """Verdicts per case: canonical members of a known group, else the listed cases."""
    rest = [c for c in verdicts.columns if c not in (group, case_ids)]
    known = verdicts.join(members, group).select(group, "case_id", *rest)
    listed = verdicts.join(members.select(group).distinct(), group, "left_anti").select(
        group, F.explode(case_ids).alias("case_id"), *rest
    )
    return known.unionByName(listed)


def paired_labels(
    a: DataFrame, b: DataFrame, keys: list[str], label: str, reason: str | None = None
) -> DataFrame:
    """Full outer pairing of two classifiers' labels."""
    extra = [reason] if reason else []

    def side(df, s):
        return df.select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in [label, *extra]])

    return side(a, "a").join(side(b, "b"), keys, "full_outer")


def confusion_matrix(pairs: DataFrame, label: str) -> DataFrame:
    """Counts per (label of a, label of b) over cases both have labelled."""
    a, b = f"{label}_a", f"{label}_b"
    return (
        pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def compare_labels(pairs: DataFrame, label: str, reason: str | None = None, bug: str = "BUG"):
    """Shared and one-sided cases, agreement rate and culprit agreement, as one row."""
    a, b = F.col(f"{label}_a"), F.col(f"{label}_b")
    both = a.isNotNull() & b.isNotNull()

    def n(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))

    aggs = [
        n(both).alias("n_shared"),
        n(a.isNotNull() & b.isNull()).alias("only_a"),
        n(a.isNull() & b.isNotNull()).alias("only_b"),
        n(both & (a == b)).alias("n_agree"),
        rounded(ratio(n(both & (a == b)), n(both)) * 100, 1).alias("agreement_pct"),
    ]
    if reason:
        ca, cb = culprit_file(F.col(f"{reason}_a")), culprit_file(F.col(f"{reason}_b"))
        bugs = (a == bug) & (b == bug)
        aggs += [
            n(bugs).alias("shared_bugs"),
            n(bugs & ca.isNotNull() & cb.isNotNull()).alias("both_named"),
            n(bugs & (ca == cb)).alias("same_culprit"),
        ]
    return pairs.agg(*aggs)


def top_disagreements(pairs: DataFrame, label: str, n: int = 10) -> DataFrame:
    a, b = f"{label}_a", f"{label}_b"
    return (
        confusion_matrix(pairs, label)
        .where(F.col(a) != F.col(b))
        .orderBy(F.desc("n"), a, b)
        .limit(n)
    )


# The verdict classes a run is summed up by.
SUMMARY_CLASSES = ("BUG", "NEEDS_REVIEW", "FALSE_POSITIVE", "AUTO_CLASSIFIED")


def run_summary(verdicts: DataFrame, run: list[str], tokens=("tokens_in", "tokens_out")):
    """Counts per class and token sums per run."""
    return verdicts.groupBy(*run).agg(
        F.count(F.lit(1)).alias("total_cases"),
        *[
            F.sum(F.when(F.col("classification") == c, 1).otherwise(0)).alias(f"n_{c.lower()}")
            for c in SUMMARY_CLASSES
        ],
        *[F.coalesce(F.sum(t), F.lit(0)).alias(f"total_{t}") for t in tokens if t in verdicts.columns],
    )


def test_fragments(cases: DataFrame, name: str) -> DataFrame:
    return cases.select(F.explode(name_fragments(F.col(name))).alias("fragment")).distinct()


def clean_fragments(lines: DataFrame, text: str) -> DataFrame:
    """Fragments from free text: back-quotes, bracketed remarks and ``#`` lines removed."""
    x = F.trim(F.regexp_replace(F.trim(F.col(text)), "^`+|`+$", ""))
    x = F.lower(F.trim(F.regexp_replace(x, r"\s*\(.*?\)", "")))
    return (
        lines.where(~F.trim(text).startswith("#"))
        .select(x.alias("fragment"))
        .where(F.col("fragment") != "")
        .distinct()
    )


def cause_fragments(rows: DataFrame, cause: str) -> DataFrame:
    """Fragments of a cause column, split on a slash between blanks only."""
    return clean_fragments(
        rows.select(F.explode(F.split(cause, r"\s+/\s+")).alias("_part")), "_part"
    )


def relevant_changes(
    paths: DataFrame, path: str, fragments: DataFrame, fragment: str, mode: str = "auto"
) -> DataFrame:
    """(fragment, path, match): changed paths each fragment points to.

    An exact hit is the whole path or a tail of it at a folder boundary: tails are exploded
    and equi-joined. ``fuzzy`` accepts the fragment anywhere in the path, found by its rarest
    gram, so neither mode pairs every path with every fragment. ``auto`` is fuzzy only for
    fragments without exact hit.
    """
    p = paths.select(path).distinct().withColumn("_p", F.lower(path))
    f = fragments.select(F.lower(fragment).alias("_f")).where(F.col("_f") != "").distinct()
    tails = p.select(path, F.explode(path_suffixes(F.col("_p"))).alias("_f"))
    exact = (
        tails.join(f, "_f").select("_f", path).distinct().withColumn("match", F.lit("exact"))
    )
    if mode == "exact":
        out = exact
    else:
        rest = f if mode == "fuzzy" else f.join(exact.select("_f"), "_f", "left_anti")
        held = contained(p, "_p", rest, "_f").join(p, "_p")
        fuzzy = held.select("_f", path).withColumn("match", F.lit("fuzzy"))
        out = fuzzy if mode == "fuzzy" else exact.unionByName(fuzzy)
    return out.select(F.col("_f").alias("fragment"), path, "match")


def unmatched_fragments(fragments: DataFrame, fragment: str, hits: DataFrame) -> DataFrame:
    return (
        fragments.select(F.lower(fragment).alias("fragment"))
        .distinct()
        .join(hits.select("fragment"), "fragment", "left_anti")
    )


def named_blocks(failures: DataFrame, case_id: str, matched: str, blocks: DataFrame, path: str) -> DataFrame:
    """(case, path): changed files named in ``matched``, names separated by ``|``.

    A name stands for every path that ends with it, at a folder boundary or not, and for every
    path with the same file name.
    """
    part = F.explode(F.transform(F.split(F.lower(matched), r"\|"), F.trim)).alias("_f")
    names = cut_lineage(failures.select(case_id, part).where("_f <> ''").distinct())
    low = cut_lineage(blocks.select(path).distinct().withColumn("_p", F.lower(path)))
    tails = contained(low, "_p", names, "_f").where(F.endswith("_p", "_f"))
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    same = names.select("_f", last("_f").alias("_b")).distinct().join(low.select("_p", last("_p").alias("_b")), "_b")
    hits = tails.select("_p", "_f").union(same.select("_p", "_f")).distinct()
    hits = cut_lineage(hits.join(low, "_p").select("_f", path).distinct())
    # Few bytes of names may stand for very many paths, so cases are dealt by the pairs they will make.
    pairs = names.join(hits.groupBy("_f").agg(F.count("*").alias("_n")), "_f").agg(F.sum("_n")).first()[0]
    return names.repartition(tasks_for(pairs), case_id).join(hits, "_f").select(case_id, path).distinct()


def blocks_for_failure(
    failures: DataFrame,
    case_id: str,
    name: str,
    component: str,
    blocks: DataFrame,
    path: str,
    hits: DataFrame | None = None,
    n: int = 3,
) -> DataFrame:
    """Up to ``n`` changed files per failure: named files, then component words, then name words.

    A word counts wherever the lower-cased path contains it; the earlier source ranks first, then
    the path. A failure's best ``n`` of a source are among the best ``n`` of each of its words, so a
    word that many paths contain hands on no more than that.
    """
    low = blocks.select(path).distinct().withColumn("_p", F.lower(path))
    tokens = failures.select(
        case_id, F.explode(F.split(F.lower(component), r"[\s/\-_]")).alias("_w"), F.lit(2).alias("_rank")
    ).where(F.length("_w") > 3).union(
        failures.select(
            case_id, F.explode(F.split(F.lower(name), r"[.\-/_ >]")).alias("_w"), F.lit(3).alias("_rank")
        ).where(F.length("_w") > 5)
    ).distinct()
    holds = contained(low, "_p", tokens, "_w").join(low, "_p").select("_w", path)
    found = tokens.join(top_per_group(holds, ["_w"], [F.col(path)], n), "_w").select(case_id, path, "_rank")
    if hits is not None:
        found = found.unionByName(hits.select(case_id, path, F.lit(1).alias("_rank")))
    best = found.groupBy(case_id, path).agg(F.min("_rank").alias("source_rank"))
    return top_per_group(best, [case_id], [F.col("source_rank"), F.col(path)], n)


def shared_ui_changes(
    blocks: DataFrame,
    path: str,
    changed: str,
    patterns=SHARED_UI_PATTERNS,
    max_lines: int = SHARED_UI_MAX_LINES,
) -> DataFrame:
    """Changed files under shared-UI paths with 1 to ``max_lines`` changed lines."""
    one = "|".join(f"(?:{p})" for p in patterns)
    return blocks.where(
        F.col(path).rlike(one) & (F.col(changed) > 0) & (F.col(changed) <= max_lines)
    )


def backfill_blanks(rows: DataFrame, lookup: DataFrame, keys: list[str], columns: list[str]):
    """Lookup values only where the row's own value is null or blank."""
    look = lookup.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in columns])
    joined = rows.join(look, keys, "left")
    for c in columns:
        empty = F.col(c).isNull() | (F.trim(c) == "")
        joined = joined.withColumn(
            c, F.when(empty, F.coalesce(F.col(f"_l_{c}"), F.col(c))).otherwise(F.col(c))
        )
    return joined.select(*rows.columns)


def existence_flag(rows: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Mark join: is the key in the second set."""
    marks = keys.select(key).distinct().withColumn("_m", F.lit(True))
    return rows.join(marks, key, "left").withColumn(name, F.col("_m").isNotNull()).drop("_m")


def resolve_build_metadata(given: DataFrame, known: DataFrame, build: str, source: str):
    """Hash, name and routine per build: given value, then the dimension, then generated.

    ``hash_differs`` flags a given hash that is not the stored one; ``unresolved`` a build
    with no hash at all.
    """
    look = known.select(
        build,
        F.col("git_hash").alias("_hash"),
        F.col("build_name").alias("_name"),
        F.col("routine_id").alias("routine_id"),
    )
    rows = given.join(look, build, "left")
    own_hash = F.nullif(F.col("given_hash"), F.lit(""))
    return rows.select(
        build,
        F.coalesce(own_hash, "_hash").alias("git_hash"),
        F.coalesce(
            F.nullif(F.col("given_name"), F.lit("")),
            "_name",
            F.concat(F.col(source), F.lit(":"), F.col(build).cast("string")),
        ).alias("build_name"),
        "routine_id",
        F.coalesce(own_hash != F.col("_hash"), F.lit(False)).alias("hash_differs"),
        F.coalesce(own_hash, "_hash").isNull().alias("unresolved"),
    )
