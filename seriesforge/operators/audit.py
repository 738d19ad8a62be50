"""Dependency audit: requirement texts to verdicts, as a chain of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Patterns of requirement lines; fixed values.
NAME = r"^([A-Za-z0-9][A-Za-z0-9._-]*)"
VERSION = r"==\s*([A-Za-z0-9][A-Za-z0-9._!+-]*)"
SLUG = r"(?:github\.com[/:])?([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+?)(?:\.git)?/?$"
VERDICTS = ("critical", "high", "watch", "healthy", "unknown")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalise(name: Column) -> Column:
    return F.translate(F.lower(strip(name)), "_", "-")


def parse_requirements(texts: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, name, version, pos): dependencies of each text, the first line of a name wins; version only where pinned."""
    lines = texts.select(key, F.posexplode(F.split(text, r"\r\n|[\n\r]")).alias("pos", "raw"))
    spec = lines.withColumn("line", strip(F.substring_index("raw", "#", 1))).filter("line <> '' AND NOT startswith(line, '-') AND NOT contains(line, '://')")
    spec = spec.withColumn("spec", strip(F.substring_index("line", ";", 1))).filter(F.col("spec").rlike(NAME))
    version = F.regexp_extract("spec", VERSION, 1)
    found = spec.select(key, "pos", normalise(F.regexp_extract("spec", NAME, 1)).alias("name"), F.when(version != "", version).alias("version"))
    return found.groupBy(key, "name").agg(F.min_by("version", "pos").alias("version"), F.min("pos").alias("pos"))


def parse_pyproject(texts: DataFrame, key: str = "doc", text: str = "text") -> DataFrame:
    """(key, name, version, pos) from pyproject texts: project, optional and poetry tables; broken files give nothing."""

    def run(batches):
        import tomllib

        import pandas as pd

        for pdf in batches:
            rows = []
            for k, t in zip(pdf[key], pdf[text], strict=True):
                try:
                    data = tomllib.loads(t or "")
                except tomllib.TOMLDecodeError:
                    continue
                project = data.get("project") or {}
                listed = list(project.get("dependencies") or [])
                for extra in (project.get("optional-dependencies") or {}).values():
                    listed += extra or []
                poetry = ((data.get("tool") or {}).get("poetry") or {}).get("dependencies") or {}
                listed += [n for n in poetry if n.lower() != "python"]
                rows += [(k, i, line) for i, line in enumerate(listed)]
            yield pd.DataFrame(rows, columns=[key, "at", "line"])

    lines = texts.select(key, text).mapInPandas(run, f"{key} string, at int, line string")
    joined = lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return parse_requirements(joined, key)


def repo_slug(url: Column) -> Column:
    found = F.regexp_extract(strip(url), SLUG, 1)
    return F.when(found != "", found)


def choose_file(parsed: DataFrame, priorities: DataFrame) -> DataFrame:
    """Dependencies (repo, branch, path, name, ...) of each repo's best file that has any; priorities: (branch, path, rank)."""
    ranked = parsed.join(F.broadcast(priorities), ["branch", "path"])
    best = ranked.groupBy("repo").agg(F.min("rank").alias("rank"))
    return ranked.join(best, ["repo", "rank"])


def first_wins(parsed: DataFrame) -> DataFrame:
    """(name, version, file) over several files: the first by (file order, position)."""
    return parsed.groupBy("name").agg(F.min_by(F.struct("version", "file"), F.struct("file_order", "pos")).alias("x")).select("name", "x.*")


def week_trend(history: DataFrame) -> DataFrame:
    """(name, trend_pct) on the last 14 rows of a series; fewer rows or an empty earlier week give null."""
    ranked = history.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy(F.desc("date"))))
    sums = ranked.filter("r <= 14").groupBy("name").agg(F.count("*").alias("n"), F.sum(F.when(F.col("r") <= 7, F.col("downloads"))).alias("a"), F.sum(F.when(F.col("r") > 7, F.col("downloads"))).alias("b"))
    return sums.select("name", F.when((F.col("n") == 14) & (F.col("b") > 0), F.round((F.col("a") / F.col("b") - 1) * 100, 1)).alias("trend_pct"))


def exposure(deps: DataFrame, advisories: DataFrame) -> DataFrame:
    """Dependencies (doc, name, version) with vuln count, worst severity rank and kind.

    Pinned: only advisories that affect the version count ('active'); else all of them ('historical'). One pass over
    the advisories per name: the join carries (version, name) pairs, not copies per document.
    """
    wanted = deps.select("name", "version").distinct()
    hits = wanted.join(advisories, "name").filter(F.col("version").isNull() | F.array_contains("affected_versions", F.col("version")))
    told = hits.groupBy("name", "version").agg(F.count("*").alias("vuln_count"), F.max("severity_rank").alias("severity_rank"))
    told = told.select(F.col("name").alias("_n"), F.col("version").alias("_v"), "vuln_count", "severity_rank")
    kind = F.when(F.col("version").isNotNull(), "active").otherwise("historical")
    joined = deps.join(told, (F.col("name") == F.col("_n")) & F.col("version").eqNullSafe(F.col("_v")), "left").drop("_n", "_v")
    return joined.withColumn("vuln_count", F.coalesce("vuln_count", F.lit(0))).withColumn("vuln_kind", kind)


def verdict(risk: str = "risk_score", vuln: str = "vuln_count", severity: str = "max_severity", days: str = "days_since_last_release",
            archived: str = "archived", trend: str = "trend_pct", kind: str = "vuln_kind") -> Column:
    """struct(verdict, reason): the first rule that holds; an unknown value meets no rule."""
    c = F.col
    n, sev, risk_c = F.coalesce(c(vuln), F.lit(0)).cast("int"), F.upper(F.coalesce(c(severity), F.lit(""))), F.coalesce(c(risk), F.lit(0.0))
    plural = F.when(n == 1, "").otherwise("s")
    active = (c(kind) == "active") & (n > 0)
    rules = [
        (c(archived).eqNullSafe(True), "critical", F.lit("archived / removed upstream")),
        (active & sev.isin("HIGH", "CRITICAL"), "critical", F.concat(F.format_string("pinned version exposed to %d %s vuln", n, F.lower(sev)), plural)),
        (active, "high", F.concat(F.format_string("pinned version exposed to %d known vuln", n), plural)),
        (risk_c >= 66, "high", F.lit("high composite maintenance risk")),
        (c(days) > 365, "watch", F.format_string("no release in %d days", c(days).cast("int"))),
        (c(trend) < -20, "watch", F.format_string("downloads down %.0f%% week-over-week", F.abs(c(trend)))),
        ((c(kind) == "historical") & (n > 0), "watch", F.format_string("%d historical CVEs — pin a version to check exposure", n)),
        (risk_c >= 40, "watch", F.lit("elevated maintenance risk")),
    ]
    out = F.struct(F.lit("healthy").alias("verdict"), F.lit("actively maintained").alias("reason"))
    for test, name, why in reversed(rules):
        out = F.when(test, F.struct(F.lit(name).alias("verdict"), why.alias("reason"))).otherwise(out)
    return out


def audit(exposed: DataFrame, known: DataFrame, trends: DataFrame) -> DataFrame:
    """Verdict per dependency: known entities by normalised name, stored risk before the composite; others 'unknown'."""
    k = known.withColumn("name", normalise(F.col("name"))).withColumn("_known", F.lit(True)).withColumn("risk_score", F.coalesce("stored_risk", "composite"))
    t = trends.withColumn("name", normalise(F.col("name")))
    j = exposed.join(k, "name", "left").join(t, "name", "left").withColumn("v", verdict())
    unknown = F.struct(F.lit("unknown").alias("verdict"), F.lit("not tracked").alias("reason"))
    return j.withColumn("v", F.when(F.col("_known"), F.col("v")).otherwise(unknown)).select(*exposed.columns, "risk_score", "v.verdict", "v.reason")


def audit_summary(audited: DataFrame, by: list[str] | None = None) -> DataFrame:
    counts = [F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS]
    return audited.groupBy(*(by or [])).agg(F.count("*").alias("audited"), F.count_if((F.col("vuln_kind") == "active") & (F.col("vuln_count") > 0)).alias("exposed"), *counts)


def audit_order(audited: DataFrame) -> DataFrame:
    """Worst verdict first, then risk, then name."""
    rank = F.array_position(F.array(*[F.lit(v) for v in VERDICTS]), F.col("verdict"))
    return audited.orderBy(rank, F.desc(F.coalesce("risk_score", F.lit(0.0))), "name")
