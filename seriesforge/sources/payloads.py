"""Normalisers of landed JSON payloads: (name, payload) tables to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesforge.functions.columns import SEVERITY_RANK, lookup

#: Keys under which a project's source is looked for, best first; fixed values.
URL_KEYS = ("source", "repository", "source code", "code", "github", "homepage", "home")


def daily_series(payloads: DataFrame) -> DataFrame:
    """(name, date, downloads) from {data: [{category, date, downloads}]}; bad dates go, null downloads count 0."""
    kind = "struct<data: array<struct<category: string, date: string, downloads: bigint>>>"
    rows = payloads.select("name", F.explode(F.from_json("payload", kind)["data"]).alias("r")).filter("r.category = 'without_mirrors'")
    dated = rows.select("name", F.col("r.date").try_cast("date").alias("date"), F.coalesce("r.downloads", F.lit(0)).alias("downloads"))
    return dated.filter("date IS NOT NULL")


def download_summary(names: DataFrame, history: DataFrame) -> DataFrame:
    """Calendar sums on each name's last day: 1, 7 and 28 days, velocity, acceleration; a name without days has nulls."""
    ended = history.join(history.groupBy("name").agg(F.max("date").alias("last")), "name")
    age = F.datediff("last", "date")

    def total(a: int, b: int) -> Column:
        return F.coalesce(F.sum(F.when((age >= a) & (age < b), F.col("downloads"))), F.lit(0))

    sums = ended.groupBy("name").agg(total(0, 1).alias("downloads_1d"), total(0, 7).alias("downloads_7d"), total(0, 28).alias("downloads_28d"), total(7, 14).alias("_p"))
    return names.select("name").join(sums, "name", "left").select(
        "name", "downloads_1d", "downloads_7d", "downloads_28d", F.round(F.col("downloads_7d") / 7, 2).alias("download_velocity"),
        (F.col("downloads_7d") - F.col("_p")).cast("double").alias("download_acceleration"), F.col("downloads_7d").isNotNull().alias("ok"),
    )


def release_cadence(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Versions with files: their count, days since the newest and mean gap in days (one decimal)."""
    kind = "struct<releases: map<string, array<struct<upload_time: string>>>>"
    files = payloads.select("name", F.explode_outer(F.from_json("payload", kind)["releases"]).alias("version", "files"))
    first = F.array_min(F.transform("files", lambda f: F.try_to_timestamp(f["upload_time"])))
    per = files.select("name", first.alias("at")).groupBy("name").agg(F.count("at").alias("version_count"), F.max("at").alias("newest"), F.min("at").alias("oldest"))

    def days(a: Column, b: Column) -> Column:
        return (F.unix_timestamp(b) - F.unix_timestamp(a)) / 86400

    return per.select(
        "name", "version_count", F.round(days(F.col("newest"), as_of), 1).alias("days_since_last_release"),
        F.when(F.col("version_count") >= 2, F.round(days(F.col("oldest"), F.col("newest")) / (F.col("version_count") - 1), 1)).alias("release_cadence_days"),
    )


def repo_url(urls: Column) -> Column:
    """Best URL of a project_urls map: by key priority, else any that names the code host."""
    entries = F.map_entries(urls)
    rank = F.array(*[F.lit(k) for k in URL_KEYS])
    known = F.filter(entries, lambda e: (F.array_position(rank, F.lower(e["key"])) > 0) & e["value"].contains("github.com"))
    ordered = F.array_sort(F.transform(known, lambda e: F.struct(F.array_position(rank, F.lower(e["key"])).alias("p"), e["value"].alias("v"))))
    other = F.array_sort(F.filter(F.map_values(urls), lambda v: v.contains("github.com")))
    return F.coalesce(F.get(ordered, F.lit(0))["v"], F.get(other, F.lit(0)))


def owner_repo(url: Column) -> Column:
    """'owner/repo' of a code-host URL, without '.git'; null for other URLs."""
    pattern = r"(?i)github\.com/([^/]+)/([^/#?]+)"
    found = F.concat_ws("/", F.regexp_extract(url, pattern, 1), F.regexp_replace(F.regexp_extract(url, pattern, 2), r"\.git$", ""))
    return F.when(url.rlike(pattern), found)


def resolve_repo(override: Column, metadata_url: Column, registry_url: Column) -> Column:
    return F.coalesce(override, owner_repo(metadata_url), owner_repo(registry_url))


def vulnerability_rollup(payloads: DataFrame, as_of: Column) -> DataFrame:
    """Counts (all, published within 14 and 28 days) and the worst severity; a payload without the list counts 0."""
    kind = "struct<vulns: array<struct<id: string, published: string, severity: string>>>"
    v = payloads.select("name", F.explode_outer(F.from_json("payload", kind)["vulns"]).alias("v"))
    age = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp(F.try_to_timestamp("v.published"))) / 86400)
    rank = F.max(lookup(F.upper("v.severity"), SEVERITY_RANK))
    return v.groupBy("name").agg(
        F.count("v.id").alias("vuln_count"), F.count_if(age <= 14).alias("vuln_new_14d"), F.count_if(age <= 28).alias("vuln_new_28d"),
        lookup(rank, {1: "LOW", 2: "MODERATE", 3: "HIGH", 4: "CRITICAL"}).alias("max_severity"),
    )


def default_version(versions: Column) -> Column:
    """Version marked default, else the last one."""
    return F.coalesce(F.get(F.filter(versions, lambda v: v["isDefault"]), F.lit(0))["version"], F.try_element_at(versions, F.lit(-1))["version"])


def dependency_count(nodes: Column) -> Column:
    return F.size(F.filter(nodes, lambda n: ~n["relation"].eqNullSafe("SELF")))


def check_score(checks: Column, name: str) -> Column:
    """Score of a named check; unknown (null or negative) stays null."""
    score = F.get(F.filter(checks, lambda c: c["name"] == name), F.lit(0))["score"]
    return F.when(score >= 0, score)


def commits_4w(weeks: Column) -> Column:
    """Sum of the last four weekly totals."""
    last = F.slice(weeks, F.greatest(F.lit(1), F.size(weeks) - 3), F.lit(4))
    return F.aggregate(last, F.lit(0).cast("bigint"), lambda s, w: s + F.coalesce(w, F.lit(0).cast("bigint")))


def velocity_counts(events: DataFrame, key: str, as_of: Column, kinds: dict[str, str]) -> DataFrame:
    """Events of each kind within the seven days before a moment, per key."""
    recent = events.filter((F.col("ts") >= as_of - F.expr("INTERVAL 7 DAYS")) & (F.col("ts") < as_of))
    return recent.groupBy(key).agg(*[F.count_if(F.col("event_type") == k).alias(n) for n, k in kinds.items()])


def source_status(flags: dict[str, Column]) -> Column:
    return F.create_map(*[x for k, c in flags.items() for x in (F.lit(k), F.coalesce(c, F.lit(False)))])


def merge_sources(watchlist: DataFrame, sources: list[DataFrame], precedence: dict[str, list[str]]) -> DataFrame:
    """One row per watched name: sources joined on, each field the first non-null of its columns (0 and false are values)."""
    out = watchlist
    for s in sources:
        out = out.join(s, "name", "left")
    fields = [F.coalesce(*cols).alias(field) for field, cols in precedence.items()]
    return out.select("name", "category", *fields)


def collection_stats(snapshots: DataFrame, history: DataFrame) -> DataFrame:
    s = snapshots.agg(F.count("*").alias("packages"), F.count("downloads_7d").alias("with_downloads"))
    return s.crossJoin(history.agg(F.count("*").alias("history_rows")))


def failures(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter("downloads_7d IS NULL")


def retry_merge(snapshots: DataFrame, retry: DataFrame) -> DataFrame:
    """Failed rows replaced whole by a second attempt that has downloads; ``origin`` tells."""
    second = retry.filter("downloads_7d IS NOT NULL").select("name", F.struct(*snapshots.columns).alias("_again"))
    joined = snapshots.select("name", F.struct(*snapshots.columns).alias("_row")).join(second, "name", "left")
    again = F.col("_row.downloads_7d").isNull() & F.col("_again").isNotNull()
    chosen = joined.select(F.when(again, F.col("_again")).otherwise(F.col("_row")).alias("r"), F.when(again, "recovered").otherwise("ingested").alias("origin"))
    return chosen.select("r.*", "origin")


def carry_forward(snapshots: DataFrame, earlier: DataFrame) -> DataFrame:
    """Rows still without downloads become the name's newest earlier row that has them, stamped as this run's.

    ``snapshots`` has an ``origin`` column; names without such a row stay as they are.
    """
    stamps = ("run_id", "snapshot_date", "ingested_at")
    columns = [c for c in snapshots.columns if c != "origin"]
    row = F.struct(*columns)
    before = earlier.filter("downloads_7d IS NOT NULL").groupBy("name").agg(F.max_by(row, F.struct("snapshot_date", "run_id")).alias("_old"))
    joined = snapshots.join(before, "name", "left")
    use = F.col("downloads_7d").isNull() & F.col("_old").isNotNull()
    kept = [F.col(c) if c in stamps else F.when(use, F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    return joined.select(*kept, F.when(use, "carried_forward").otherwise(F.col("origin")).alias("origin"))


def healing_stats(healed: DataFrame) -> DataFrame:
    lost = F.col("downloads_7d").isNull()
    return healed.agg(
        F.count_if(lost | F.col("origin").isin("recovered", "carried_forward")).alias("failed"),
        F.count_if(F.col("origin") == "recovered").alias("recovered"), F.count_if(F.col("origin") == "carried_forward").alias("carried_forward"),
    )
