"""Materialise, publish and export marts; look at tables without surprises."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sitelens.plans.workspace import Workspace
from sitelens.sources.files import bytes_below, children, exists, move, remove
from sitelens.sources.footers import row_counts

# fixed values: mart order, and name parts a portable column must not contain
MART_ORDER = ["identity_xwalk", "facility_metrics", "market_summary", "market_flows", "build_metadata"]
PII_TOKENS = (
    "first_name", "last_name", "dob", "birth", "email", "phone", "ssn",
    "mrn", "address", "member_name", "patient_name",
)
PII_ALLOWED = frozenset({"facility_name"})
PORTABLE_LIMIT_BYTES = 100_000_000


class PersonalDataError(RuntimeError):
    """An export would have carried columns that look personal."""


class OversizeError(RuntimeError):
    """A portable set is larger than its limit."""


def materialize(df: DataFrame, path: str) -> int:
    """Write one mart and return its row count, taken during the write."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def build_marts(
    work: Workspace, root: str, version: str, names: Iterable[str] = MART_ORDER
) -> dict[str, int]:
    """Write every mart of one version into a folder no reader looks at yet.

    Marts go in dependency order, and a later mart reads the earlier ones back from
    what was written instead of computing them again.
    """
    counts = {}
    for name in names:
        df = work.build_metadata() if name == "build_metadata" else getattr(work, name)
        path = f"{root}/v={version}/{name}"
        counts[name] = materialize(df, path)
        work.use(name, df.sparkSession.read.schema(df.schema).parquet(path))
    return counts


class Superseded(RuntimeError):
    """Somebody has published since the caller looked."""


def publish(
    work: Workspace,
    root: str,
    version: str,
    at: datetime,
    names: Iterable[str] = MART_ORDER,
    expected: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Build a version of some or all marts aside, then make it current by one entry of the log.

    Every mart has a current version of its own, so that publishing a few leaves the others as
    they are.  Readers resolve versions through the log: they see the previous set or the new one,
    and files of the previous set stay untouched while they read.  With ``expected`` (what
    ``current_versions`` gave) nothing is published if the log has moved on meanwhile.
    """
    spark = work.net.spark
    counts = build_marts(work, root, version, names)
    if expected is not None and current_versions(spark, root) != dict(expected):
        raise Superseded(f"{root} was published to since; version {version} stays unlisted")
    entry = spark.createDataFrame(
        [(version, at, name, n) for name, n in counts.items()],
        "version string, published_at timestamp_ntz, mart string, n_rows bigint",
    )
    entry.coalesce(1).write.mode("append").parquet(f"{root}/log")  # one row per mart
    return counts


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """The current version of every mart."""
    if not exists(spark, f"{root}/log"):
        return {}
    log = spark.read.parquet(f"{root}/log")
    newest = log.groupBy("mart").agg(F.max_by("version", F.struct("published_at", "version")).alias("v"))
    return {r.mart: r.v for r in newest.collect()}  # one row per mart


def open_marts(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    """The marts at their current versions; ``views`` also registers ``marts_<name>``."""
    versions = current_versions(spark, root)
    found = {}
    for name in sorted(versions, key=lambda n: (MART_ORDER.index(n) if n in MART_ORDER else len(MART_ORDER), n)):
        found[name] = spark.read.parquet(f"{root}/v={versions[name]}/{name}")
        if views:
            found[name].createOrReplaceTempView(f"marts_{name}")
    return found


def remove_unlisted(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of mart versions that are no longer current; returns their names.

    For a time at which no reader holds an older set open and nobody is building.
    """
    versions = current_versions(spark, root)
    gone = []
    for folder in children(spark, root):
        if not folder.startswith("v="):
            continue
        for name in children(spark, f"{root}/{folder}"):
            if versions.get(name) != folder[2:]:
                remove(spark, f"{root}/{folder}/{name}")
                gone.append(f"{folder}/{name}")
    return sorted(gone)


def personal_columns(
    marts: Mapping[str, DataFrame], tokens: Iterable[str] = PII_TOKENS, allowed: frozenset[str] = PII_ALLOWED
) -> list[tuple[str, str]]:
    return [
        (name, column)
        for name, df in marts.items()
        for column in df.columns
        if column not in allowed and any(t in column.lower() for t in tokens)
    ]


def export_portable(
    spark: SparkSession,
    marts: Mapping[str, DataFrame],
    path: str,
    tokens: Iterable[str] = PII_TOKENS,
    allowed: frozenset[str] = PII_ALLOWED,
    limit_bytes: int = PORTABLE_LIMIT_BYTES,
) -> int:
    """Copy the marts to a self-contained folder; refuses personal columns and oversize.

    The copy is written beside ``path`` and measured there; only a set within the limit is moved
    to ``path``, where it replaces an older one.
    """
    leaks = personal_columns(marts, tokens, allowed)
    if leaks:
        raise PersonalDataError("refusing to export: " + ", ".join(f"{m}.{c}" for m, c in leaks))
    if not marts:
        raise ValueError("nothing to export")
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    for name, df in marts.items():
        df.write.option("compression", "zstd").parquet(f"{aside}/{name}")
    size = bytes_below(spark, aside)
    if size > limit_bytes:
        remove(spark, aside)
        raise OversizeError(f"portable set has {size} bytes, limit {limit_bytes}")
    move(spark, aside, path)
    return size


class Page(NamedTuple):
    rows: list[Row]
    truncated: bool


ROW_CAP, SOURCE_ROW_CAP, CELL_CAP = 500, 200, 120  # fixed values: reply sizes


def bounded(df: DataFrame, cap: int = ROW_CAP) -> Page:
    """At most ``cap`` rows for display, and whether there were more."""
    rows = df.limit(cap + 1).collect()
    return Page(rows[:cap], len(rows) > cap)


def as_text(page: Page, columns: list[str]) -> str:
    """Tab-separated display of a page; long cells are cut."""

    def cell(value: object) -> str:
        shown = "" if value is None else str(value)
        return shown if len(shown) <= CELL_CAP else shown[:CELL_CAP] + "…"

    lines = ["\t".join(columns), *("\t".join(cell(v) for v in row) for row in page.rows)]
    if page.truncated:
        lines.append(f"[truncated at {len(page.rows)} rows]")
    return "\n".join(lines)


def list_tables(spark: SparkSession, prefix: str = "", paths: Mapping[str, str] | None = None) -> DataFrame:
    """Tables and views of the session by name, with the rows of those that lie under ``paths``.

    Counts come from Parquet footers; a table without a path has a null count.
    """
    known = row_counts(spark, paths or {})
    names = [(t.name, t.tableType, known.get(t.name)) for t in spark.catalog.listTables() if t.name.startswith(prefix)]
    return spark.createDataFrame(names, "name string, kind string, n_rows long").orderBy("name")


def describe(df: DataFrame, samples: int = 3) -> tuple[list[tuple[str, str]], Page]:
    """Columns with types, and a few sample rows."""
    return df.dtypes, bounded(df, samples)
