"""Column expressions over file paths, version strings, tickets and test names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path groups whose modules sit two folders deeper than the rest.
DEEP_PREFIXES = (
    "modules/dxp/",
    "modules/apps/commerce/",
    "modules/apps/fragment/",
    "modules/apps/headless/",
    "modules/apps/layout/",
    "modules/apps/portlet-configuration/",
    "modules/apps/push-notifications/",
    "modules/apps/site-initializer/",
    "modules/apps/static/",
)
# Paths that never take part in complexity scores.
EXCLUDED_COMPLEXITY_PATHS = r"^modules/third-party/|/antlr/|^modules/dxp/apps/osb/"
# Test and generated sources, left out of risk scores.
UNSCORED_PATHS = (
    r"Test\.java$|TestCase\.java$|TestUtil\.java$|/test/|/testIntegration/|/generated-sources/|/generated/"
)
UNSCORED_BASENAMES = r"^Base[A-Z].*Impl\.java$"
# The category part of a module path, used as the bridge key.
CATEGORY_PATTERN = (
    r"^(modules/(?:apps|dxp/apps|core|util)/[^/]+|portal-impl|portal-kernel|util-taglib).*$"
)
# Changed files that are tests, and those that are code.
TEST_PATHS = (
    r"Test\.java$|TestCase\.java$|\.spec\.ts$|\.test\.js$|\.test\.ts$|/test/|/testIntegration/"
)
CODE_PATHS = r"\.java$|\.ts$|\.tsx$|\.js$|\.jsp$|\.jsx$"
# Source files counted in inventories, and the test files among them.
SOURCE_FILES = r"\.(java|js|ts|tsx|jsx|properties)$"
INVENTORY_TEST_FILES = r"/tests?/|-tests?/|Test\.(java|js|ts|tsx)$|\.(test|spec)\.(js|ts|tsx)$"
FRONTEND_EXTENSIONS = ("js", "ts", "jsx", "tsx", "mjs")
# Files left out of a comparison of two revisions.
DIFF_EXCLUDES = (
    "**/artifact.properties",
    "**/.releng/**",
    "**/app.changelog",
    "**/app.properties",
    "**/bnd.bnd",
    "**/packageinfo",
    "**/*.xml",
    "**/*.properties",
    "**/*.yml",
    "**/*.yaml",
    "**/*.tf",
    "**/*.sh",
    "**/*.scss",
    "**/*.css",
    "**/*.gradle",
    "**/package.json",
    "**/*.json",
    "cloud/**",
)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def is_scored(path: Column) -> Column:
    """Whether a file takes part in risk scores: no test, no generated source, no generated base class."""
    return ~path.rlike(UNSCORED_PATHS) & ~base_name(path).rlike(UNSCORED_BASENAMES)


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)


def language(path: Column) -> Column:
    """Java, TypeScript, JavaScript or other, from the extension."""
    return (
        F.when(path.rlike(r"\.java$"), "java")
        .when(path.rlike(r"\.tsx?$"), "typescript")
        .when(path.rlike(r"\.jsx?$"), "javascript")
        .otherwise("other")
    )


def code_family(path: Column) -> Column:
    """java / frontend / other, the split used for complexity averages."""
    ext = extension(path)
    return (
        F.when(ext == "java", "java")
        .when(ext.isin(*FRONTEND_EXTENSIONS), "frontend")
        .otherwise("other")
    )


def module_path(path: Column) -> Column:
    """Five segments under the deep groups, three elsewhere, null outside ``modules/``."""
    deep = F.lit(False)
    for prefix in DEEP_PREFIXES:
        deep = deep | path.startswith(prefix)
    return F.when(
        deep, F.regexp_replace(path, r"^(modules/[^/]+/[^/]+/[^/]+/[^/]+).*", "$1")
    ).when(
        path.startswith("modules/"), F.regexp_replace(path, r"^(modules/[^/]+/[^/]+).*", "$1")
    )


def category_path(path: Column) -> Column:
    return F.regexp_replace(path, CATEGORY_PATTERN, "$1")


def module_of_path(path: Column) -> Column:
    """Module name: folder before ``/src/``, else the fourth segment; root modules by name."""
    return (
        F.when(path.rlike(r"^portal-[a-z]+/"), F.split_part(path, F.lit("/"), F.lit(1)))
        .when(
            path.startswith("modules/") & path.contains("/src/"),
            F.regexp_extract(path, r"([^/]+)(?=/src/)", 1),
        )
        .when(
            path.startswith("modules/"),
            F.nullif(F.regexp_extract(path, r"^(?:[^/]*/){3}([^/]+)", 1), F.lit("")),
        )
    )


def change_group(path: Column) -> Column:
    """Folder a changed file is listed under: three segments for modules, else two."""
    parts = F.split(path, "/")
    deep = (
        (F.size(parts) >= 3)
        & (parts[0] == "modules")
        & F.get(parts, F.lit(1)).isin("apps", "dxp", "test")
    )
    return (
        F.when(deep, F.concat(F.array_join(F.slice(parts, 1, 3), "/"), F.lit("/")))
        .when(F.size(parts) >= 2, F.concat(F.array_join(F.slice(parts, 1, 2), "/"), F.lit("/")))
        .otherwise(parts[0])
    )


def path_prefixes(path: Column) -> Column:
    """Every folder prefix of a path and the path itself, as an array."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )


def path_suffixes(path: Column) -> Column:
    """The path and every tail of it that starts at a folder boundary."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, n, F.size(parts)), "/"),
    )


def glob_pattern(globs) -> str:
    """One regular expression for a list of ``**``-style globs."""
    out = []
    for glob in globs:
        body = (
            glob.replace(".", r"\.")
            .replace("**/", "\0")
            .replace("**", "\1")
            .replace("*", "[^/]*")
            .replace("\0", "(?:.*/)?")
            .replace("\1", ".*")
        )
        out.append(f"^{body}$")
    return "|".join(out)


def normalise_crosswalk_key(path: Column) -> Column:
    """Both sides of the module crosswalk are compared without their leading folders."""
    return F.regexp_replace(path, r"^modules/(dxp/)?apps/", "")


def component_names(text: Column) -> Column:
    """``A|B > C`` to ``[A, C]``: the last level of each entry, blanks dropped."""
    return F.filter(
        F.transform(
            F.split(text, r"\|"),
            lambda p: F.trim(F.regexp_replace(F.trim(p), r"^.*>\s*", "")),
        ),
        lambda p: p != "",
    )


def latest_quarter(versions: Column) -> Column:
    """Highest ``20yy.Qn`` in a pipe-joined list, patch number cut off."""
    hits = F.filter(
        F.transform(F.split(versions, r"\|"), lambda p: F.trim(p)),
        lambda p: p.rlike(r"^20\d{2}\.Q[1-4]"),
    )
    return F.array_max(F.transform(hits, lambda p: F.substring(p, 1, 7)))


def leading_ticket(subject: Column) -> Column:
    """Ticket id at the head of the first word, else null."""
    return F.nullif(F.regexp_extract(subject, r"^([A-Z]+-[0-9]+)", 1), F.lit(""))


def any_ticket(subject: Column, projects) -> Column:
    """First ticket of one of ``projects`` anywhere in the text, else null."""
    return F.nullif(
        F.regexp_extract(subject, r"\b((?:" + "|".join(projects) + r")-\d+)\b", 1), F.lit("")
    )


def culprit_file(reason: Column) -> Column:
    """File named in a ``[culprit_file=...]`` marker, else null."""
    found = reason.rlike(r"\[culprit_file=[^\]]*\]")
    return F.when(found, F.trim(F.regexp_extract(reason, r"\[culprit_file=([^\]]*)\]", 1)))


# Package words that name no module.
GENERIC_PACKAGES = ("com", "internal", "test", "impl")


def name_fragments(name: Column, generic=GENERIC_PACKAGES) -> Column:
    """Class, spec-file and module tokens of a test name, to look for in changed paths."""
    spec_name = F.regexp_extract(name, r"^[^/\s>]*", 0)
    folder = F.when(name.contains("/"), F.split_part(name, F.lit("/"), F.lit(1)))
    words = F.split(name, r"\.")
    klass = F.trim(F.split_part(F.element_at(words, -1), F.lit("#"), F.lit(1)))
    package = F.get(
        F.filter(words, lambda w: ~w.isin(*generic) & (F.length(w) > 4)), F.lit(0)
    )
    local = F.lower(
        F.split_part(F.regexp_replace(name, r"LocalFile\.", ""), F.lit("#"), F.lit(1))
    )
    is_spec = name.contains(".spec.ts") | name.contains(".spec.js")
    found = (
        F.when(is_spec, F.array(spec_name, folder))
        .when(
            name.contains(".") & ~name.contains(">"),
            F.array(F.when(klass != "", F.concat(klass, F.lit(".java"))), package),
        )
        .when(name.startswith("LocalFile."), F.array(local))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x != "")))


def short_name_key(name: Column) -> Column:
    """Lower-case words of a module or component name, common suffixes removed."""
    x = F.lower(name)
    # Fixed value: the suffixes.
    x = F.regexp_replace(x, r"-impl$|-api$|-service$|-web$|-test$|-client$|-spi$|-core$|-util$", "")
    x = F.regexp_replace(x, r"[-_>]", " ")
    x = F.regexp_replace(x, r"[^a-z0-9 ]", "")
    return F.trim(F.regexp_replace(x, r"\s+", " "))
