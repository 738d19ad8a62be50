"""Fixed table schemas, row coercion, and parquet-backed append, reload, evolution and artefact sinks."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.sources import versions as V

_KINDS = {"STRING": "string", "INT": "bigint", "FLOAT": "double", "BOOL": "boolean", "DATE": "date", "TIMESTAMP": "timestamp", "JSON": "string"}


def _columns(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in text.split()]


#: Columns of the nine tables, name:KIND; fixed values.
TABLES: dict[str, list[tuple[str, str]]] = {
    "snapshots": _columns(
        "run_id:STRING snapshot_date:DATE name:STRING category:STRING repo:STRING downloads_1d:INT downloads_7d:INT downloads_28d:INT"
        " download_velocity:FLOAT download_acceleration:FLOAT monthly_downloads:INT stars:INT forks:INT open_issues:INT subscribers:INT"
        " pushed_at:TIMESTAMP created_at:TIMESTAMP commit_count_4w:INT prs_merged_7d:INT issues_opened_7d:INT bus_factor:FLOAT archived:BOOL"
        " dependent_packages_count:INT dependent_repos_count:INT rank_average:FLOAT status:STRING latest_version:STRING version_count:INT"
        " days_since_last_release:FLOAT release_cadence_days:FLOAT dependency_count:INT license:STRING scorecard_overall:FLOAT"
        " scorecard_maintained:INT scorecard_branch_protection:INT scorecard_code_review:INT vuln_count:INT vuln_new_14d:INT vuln_new_28d:INT"
        " max_severity:STRING source_status:JSON ingested_at:TIMESTAMP"
    ),
    "download_history": _columns("name:STRING date:DATE downloads:INT"),
    "features": _columns(
        "run_id:STRING name:STRING category:STRING feature_date:DATE downloads_7d:FLOAT downloads_28d:FLOAT download_velocity:FLOAT"
        " download_acceleration:FLOAT download_growth_28d:FLOAT dow_log:FLOAT stars:FLOAT forks:FLOAT open_issues:FLOAT commit_count_4w:FLOAT"
        " prs_merged_7d:FLOAT issues_opened_7d:FLOAT dependent_repos_count:FLOAT dependent_packages_count:FLOAT rank_average:FLOAT"
        " days_since_last_release:FLOAT release_cadence_days:FLOAT dependency_count:FLOAT bus_factor:FLOAT scorecard_overall:FLOAT"
        " scorecard_maintained:FLOAT vuln_count:FLOAT vuln_new_28d:FLOAT archived:FLOAT growth_target_70d:FLOAT momentum_label:STRING"
        " at_risk_label:INT is_scoring_row:BOOL"
    ),
    "predictions": _columns(
        "run_id:STRING predicted_at:TIMESTAMP name:STRING category:STRING momentum_score:FLOAT risk_score:FLOAT growth_pred_70d:FLOAT"
        " momentum_label:STRING risk_level:STRING top_reasons:JSON"
    ),
    "model_runs": _columns(
        "run_id:STRING model_name:STRING trained_at:TIMESTAMP version:STRING metric_name:STRING metric_value:FLOAT n_train:INT n_test:INT"
        " params:JSON is_champion:BOOL gcs_uri:STRING notes:STRING"
    ),
    "agent_activity": _columns("run_id:STRING ts:TIMESTAMP agent:STRING action:STRING status:STRING summary:STRING artifact_url:STRING"),
    "pipeline_runs": _columns("run_id:STRING started_at:TIMESTAMP finished_at:TIMESTAMP status:STRING stages:JSON counts:JSON git_sha:STRING"),
    "backtest": _columns("run_id:STRING created_at:TIMESTAMP payload:JSON"),
    "self_audit": _columns("run_id:STRING created_at:TIMESTAMP payload:JSON"),
}
_BY_RUN = {"snapshots", "features", "predictions", "model_runs", "agent_activity", "pipeline_runs", "backtest", "self_audit"}


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(_KINDS[k])) for n, k in TABLES[table]])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def create(spark: SparkSession, root: str) -> None:
    """Create every table that is not there yet. One that is there stays as it is, whatever state it is in."""
    for table in TABLES:
        if V.current(spark, f"{root}/{table}") is not None:
            continue
        if strange := set(V.entries(spark, f"{root}/{table}")) - {"manifests", "data"}:
            raise FileExistsError(f"{root}/{table} holds {sorted(strange)[:3]} and is no table of this library")
        try:
            V.publish(spark, f"{root}/{table}", V.following(spark, f"{root}/{table}"), [])
        except V.Conflict:
            pass  # somebody else has just created it


def _coerced(kind: str, source: T.DataType, c: Column) -> Column:
    if kind == "JSON":
        return c.cast("string") if isinstance(source, T.StringType) else F.to_json(c)
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c) if kind == "STRING" else F.lit(None).cast(_KINDS[kind])
    if kind == "FLOAT":
        y = c.try_cast("double")
        return F.when(F.isnan(y), None).otherwise(y)
    if kind == "INT" and isinstance(source, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.try_cast("bigint"))
    if kind == "STRING" and isinstance(source, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("string"))
    return c.try_cast(_KINDS[kind])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Rows in a table's schema: cast, NaN and unparsable to null, nested to JSON, unknown dropped, missing null.

    Text is cast by its meaning: 'false' becomes false.
    """
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[(_coerced(k, have[n], F.col(n)) if n in have else F.lit(None).cast(_KINDS[k])).alias(n) for n, k in TABLES[table]])


def _parts(spark: SparkSession, root: str, table: str) -> list[str]:
    found = V.current(spark, f"{root}/{table}")
    if found is None:
        raise FileNotFoundError(f"there is no table {root}/{table}")
    return found[1]


def _write_part(df: DataFrame, root: str, table: str) -> str:
    """Conformed rows in a data folder of their own, which no reader sees yet; run tables get a folder for each run."""
    name, rows = f"part={uuid4().hex}", conform(df, table)
    if table in _BY_RUN:
        # a run that holds most rows is split over several tasks
        rows.hint("rebalance", "run_id").write.partitionBy("run_id").parquet(f"{root}/{table}/data/{name}")
    else:
        rows.write.parquet(f"{root}/{table}/data/{name}")
    return name


def _publish(spark: SparkSession, root: str, table: str, lines: Callable[[list[str]], list[str]]) -> None:
    """Switch to the parts that ``lines`` makes of the present ones; tries again if another writer was first."""
    while True:
        try:
            V.publish(spark, f"{root}/{table}", V.following(spark, f"{root}/{table}"), lines(_parts(spark, root, table)))
            return V.forget(spark, f"{root}/{table}", set)
        except V.Conflict:
            continue


def append(df: DataFrame, root: str, table: str) -> None:
    """Append conformed rows: written beside the others, then named by the next manifest. All of them are seen, or none.

    Run tables are partitioned by run, so a filter on ``run_id`` reads that run's folders alone. A run id of the empty text
    reads back as null.
    """
    spark = df.sparkSession
    _parts(spark, root, table)
    part = _write_part(df, root, table)
    _publish(spark, root, table, lambda parts: [*parts, part])


def reload(df: DataFrame, root: str, table: str) -> None:
    """Replace a table's rows, which may be read from it: written once, then switched to by one manifest.

    A job that dies before the switch leaves the old rows; readers that began before it keep the version they opened, as the
    one before the newest stays on disk.
    """
    spark = df.sparkSession
    _parts(spark, root, table)
    part = _write_part(df, root, table)
    _publish(spark, root, table, lambda _: [part])


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table with all of its schema's columns, also from files written before a column was added."""
    parts = _parts(spark, root, table)
    if not parts:
        return empty(spark, table)
    reader = spark.read.schema(schema(table)).option("basePath", f"{root}/{table}/data")
    return reader.parquet(*[f"{root}/{table}/data/{p}" for p in parts]).select(*[n for n, _ in TABLES[table]])


def load_latest(spark: SparkSession, root: str, table: str, ts: str) -> DataFrame:
    """The rows of the newest run (by ``ts``, ties by run id): a two-column pass finds it, then only its folders are read."""
    rows = load(spark, root, table)
    newest = rows.agg(F.max_by("run_id", F.struct(ts, "run_id")).alias("run_id")).first()["run_id"]
    return rows.filter(F.col("run_id").eqNullSafe(F.lit(newest)))


def evolve(df: DataFrame, table: str) -> DataFrame:
    """Add the schema's columns that a frame lacks, as nulls."""
    return df.withColumns({n: F.lit(None).cast(_KINDS[k]) for n, k in TABLES[table] if n not in df.columns} or {df.columns[0]: F.col(df.columns[0])})


def query(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised SQL over frames named in braces."""
    return spark.sql(sql, args=args, **frames)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of double columns as null."""
    bad = [float("nan"), float("inf"), float("-inf")]
    return df.select(*[F.when(~F.col(c).isin(bad), F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    finite(df).write.mode("overwrite").json(path)


def scan_landed(spark: SparkSession, path: str, schema: str, kind: str = "json") -> DataFrame:
    """Landed files (json, csv or parquet) under an explicit schema: no pass to infer it, partition folders become columns."""
    reader = spark.read.schema(schema)
    return (reader.option("header", True) if kind == "csv" else reader).format(kind).load(path)


def active_features(configured: list[str], computed: list[str], default: list[str], candidate: str | None = None) -> list[str]:
    """Configured features that are computed, else the defaults; plus one candidate on trial."""
    out = [f for f in configured if f in computed] or list(default)
    return out + [candidate] if candidate and candidate not in out else out


def watchlist(spark: SparkSession, rows: list[tuple], limit: int | None = None) -> DataFrame:
    """(pos, name, category, repo_override) from rows of two or three entries, the first ``limit`` of them."""
    data = [(i, r[0], r[1], r[2] if len(r) > 2 else None) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "pos int, name string, category string, repo_override string")
    return df.filter(F.col("pos") < limit) if limit is not None else df
