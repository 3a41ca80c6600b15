"""Run and model-version tables (SRC5, PF9-PF11, JN1-JN2, AG5-AG7, SL3-SL5,
WN16, SNK5, FM9-FM10).

Runs: ``run_id, experiment, model_type, start_time, metrics map<string,double>,
params map<string,string>, artifacts array<string>``.
Versions: ``model_name, version int, run_id, aliases array<string>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import inf, pdiv
from ..session import cut_lineage, has_files
from .groups import top_k

# Fixed values that must equal the reference's registry conventions.
PRODUCTION = "Production"
MODEL_FILE = "MLmodel"


def metric(name: str, runs_col: str = "metrics") -> Column:
    """A metric from the run's map; NULL when the run did not log it."""
    return F.try_element_at(F.col(runs_col), F.lit(name))


def metric_or_inf(name: str) -> Column:
    """PF10: a missing metric ranks as +inf."""
    return F.coalesce(metric(name), inf())


def has_model_artifact(artifacts: str = "artifacts") -> Column:
    """PF9: an artifact ``model/MLmodel`` or any ``*/MLmodel``."""
    return F.exists(F.col(artifacts), lambda x: (x == f"model/{MODEL_FILE}") | x.endswith(f"/{MODEL_FILE}"))


def scan_runs(runs: DataFrame, experiments: list[str] | None, order_metric: str, limit: int | None,
              ascending: bool = True) -> DataFrame:
    """SRC5 + SL3: runs of the given experiments, best ``limit`` per experiment
    by a metric (missing metric last), ties by run_id."""
    r = runs if experiments is None else runs.where(F.col("experiment").isin(*experiments))
    m = metric(order_metric)
    o = m.asc_nulls_last() if ascending else m.desc_nulls_last()
    if limit is None:
        return r
    return top_k(r, ["experiment"], [o, F.col("run_id")], limit, salt_on="run_id")


def latest_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """SL4: newest ``n`` runs per experiment (start_time desc, run_id desc)."""
    return top_k(runs, ["experiment"], [F.col("start_time").desc(), F.col("run_id").desc()], n, salt_on="run_id")


def run_summary(runs: DataFrame, name: str = "rmse_next_day") -> DataFrame:
    """AG5: per experiment total runs, best / worst / mean metric, latest value."""
    m = metric(name)
    return runs.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("total_runs"), F.min(m).alias("best"), F.max(m).alias("worst"),
        F.avg(m).alias("mean"),
        F.max_by(m, F.struct("start_time", "run_id")).alias("latest"))


def best_run_per_type(runs: DataFrame, name: str = "rmse_next_day") -> DataFrame:
    """AG6: argmin of the metric per model type over runs with a model and a
    finite metric; ties go to the earliest (start_time, run_id)."""
    m = metric(name)
    ok = runs.where(has_model_artifact() & m.isNotNull() & ~F.isnan(m) & (m != inf()))
    key = F.struct(m, F.col("start_time"), F.col("run_id"))
    return ok.groupBy("model_type").agg(
        F.min_by(F.struct(F.col("run_id"), F.col("experiment"), m.alias("value")), key).alias("b")) \
        .select("model_type", "b.run_id", "b.experiment", "b.value")


def best_model_overall(best_per_type: DataFrame) -> DataFrame:
    """AG7: the single best of the per-type winners (strict <, first wins)."""
    return best_per_type.orderBy(F.col("value").asc(), F.col("model_type").asc()).limit(1)


def latest_version(versions: DataFrame) -> DataFrame:
    """SL5: highest version per model, numeric (10 > 9)."""
    v = F.col("version").cast("int")
    return versions.groupBy("model_name").agg(
        F.max(v).alias("version"), F.max_by(F.col("run_id"), v).alias("run_id"))


def version_of_best_run(best: DataFrame, versions: DataFrame) -> DataFrame:
    """JN1: inner join of the best runs with their registered versions; a best
    run without a version is skipped."""
    return best.join(versions, "run_id")


def unpromoted_versions(versions: DataFrame) -> DataFrame:
    """JN2: per model the highest version not carrying the Production alias,
    else the highest version."""
    promoted = F.array_contains(F.col("aliases"), PRODUCTION)
    v = F.col("version").cast("int")
    return versions.groupBy("model_name").agg(
        F.coalesce(F.max(F.when(~promoted, v)), F.max(v)).alias("version"))


def degradation(runs: DataFrame, name: str = "rmse_next_day", threshold: float = 10.0) -> DataFrame:
    """WN16: latest vs previous run per experiment (start_time, run_id order):
    change % = (new - old) / old * 100; alert only if > threshold. NULL change
    with fewer than two runs or a missing metric."""
    last2 = top_k(runs.select("experiment", "run_id", "start_time", metric(name).alias("m")),
                  ["experiment"], [F.col("start_time").desc(), F.col("run_id").desc()], 2, salt_on="run_id")
    g = last2.groupBy("experiment").agg(
        F.max(F.when(F.col("rank") == 1, F.col("run_id"))).alias("latest_run"),
        F.max(F.when(F.col("rank") == 1, F.col("m"))).alias("latest"),
        F.max(F.when(F.col("rank") == 2, F.col("m"))).alias("previous"))
    change = pdiv(F.col("latest") - F.col("previous"), F.col("previous")) * 100
    return g.select("experiment", "latest_run", "latest", "previous", change.alias("change_pct"),
                    F.coalesce(change > F.lit(float(threshold)), F.lit(False)).alias("alert"))


def register_best(runs: DataFrame, versions: DataFrame, name: str = "rmse_next_day") -> DataFrame:
    """FM9: per experiment the best run with a model and a finite metric gets
    version ``max(version) + 1`` of the model named after the experiment.
    Returns the rows to append to the versions table."""
    m = metric(name)
    ok = runs.where(has_model_artifact() & m.isNotNull() & ~F.isnan(m) & (m != inf()))
    best = ok.groupBy("experiment").agg(
        F.min_by(F.col("run_id"), F.struct(m, F.col("start_time"), F.col("run_id"))).alias("run_id"))
    cur = versions.groupBy("model_name").agg(F.max(F.col("version").cast("int")).alias("_v"))
    return (best.join(cur, best["experiment"] == cur["model_name"], "left")
            .select(F.col("experiment").alias("model_name"),
                    (F.coalesce(F.col("_v"), F.lit(0)) + 1).cast("int").alias("version"), "run_id",
                    F.array().cast("array<string>").alias("aliases")))


def promote(versions: DataFrame, chosen: DataFrame, alias: str = PRODUCTION) -> DataFrame:
    """FM10: point ``alias`` at the chosen (model_name, version); it moves off
    every other version of that model. Models not in ``chosen`` keep theirs."""
    c = chosen.select("model_name", F.col("version").cast("int").alias("_chosen"))
    j = versions.join(c, "model_name", "left")
    stripped = F.array_remove(F.col("aliases"), alias)
    new = (F.when(F.col("_chosen").isNull(), F.col("aliases"))
           .when(F.col("version") == F.col("_chosen"), F.array_union(stripped, F.array(F.lit(alias))))
           .otherwise(stripped))
    return j.select("model_name", "version", "run_id", new.alias("aliases"))


def run_records(metrics: DataFrame, data: DataFrame, experiment: Column, model_type: Column, params: dict[str, Column | str],
                keys: list[str], tags: dict[str, str] | None = None, artifacts: list[str] | None = None,
                start_time: Column | None = None) -> DataFrame:
    """SNK5: one row per key group in the columns of the runs table, with ``tags``.

    ``metrics`` (keys, one column per metric; NULLs are not logged); ``data`` (keys, dt): the rows that
    the run was trained on, whose number and range become parameters. ``run_id`` is a hash of
    experiment, model type, keys, parameters and data range, so the same run has the same id."""
    stats = data.groupBy(*keys).agg(F.count(F.lit(1)).cast("string").alias("_rows"), F.min("dt").cast("string").alias("_start"), F.max("dt").cast("string").alias("_end"))
    names = [c for c in metrics.columns if c not in keys]
    mmap = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("double"))]), lambda k, v: v.isNotNull())
    own = {k: (v if isinstance(v, Column) else F.lit(str(v))).cast("string") for k, v in params.items()}
    own |= {"data_samples": F.col("_rows"), "data_start_date": F.col("_start"), "data_end_date": F.col("_end")}
    pmap = F.map_filter(F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    run_id = F.sha2(F.concat_ws("|", blank(experiment), blank(model_type), *[blank(F.col(k)) for k in keys], *[blank(own[k]) for k in sorted(own)]), 256)
    tmap = F.create_map(*[x for k, v in (tags or {}).items() for x in (F.lit(k), F.lit(str(v)))]).cast("map<string,string>")
    return metrics.join(stats, keys, "left").select(
        F.substring(run_id, 1, 32).alias("run_id"), experiment.alias("experiment"), model_type.alias("model_type"),
        (start_time if start_time is not None else F.current_timestamp()).cast("timestamp").alias("start_time"),
        mmap.alias("metrics"), pmap.alias("params"), F.array(*[F.lit(a) for a in artifacts or []]).cast("array<string>").alias("artifacts"), tmap.alias("tags"))


def append_runs(records: DataFrame, path: str) -> int:
    """Appends the records whose run_id the log at ``path`` does not hold; how many they were.
    The new rows are written once and read back from there, so a rerun adds nothing."""
    spark = records.sparkSession
    once = cut_lineage(records.dropDuplicates(["run_id"]))
    if has_files(spark, path):
        once = cut_lineage(once.join(spark.read.parquet(path).select("run_id"), "run_id", "left_anti"))
    n = once.count()
    if n:
        once.write.mode("append").parquet(path)
    return n
