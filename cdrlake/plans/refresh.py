"""Landing to Silver to Gold: only the months that newly landed rows touch are built again."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, RunResult
from ..functions import casting as C
from ..functions import codes as K
from ..operators import gold, silver
from ..operators.filters import in_window
from ..sinks.tables import drop_partitions, remove, write_table
from ..session import tidy_shuffles
from ..sources import files
from ..sources.tables import path_exists, read_table
from .batch import clustered_cdr, publish
from .runs import audited


@dataclass(frozen=True)
class Entity:
    """How the landed rows of an entity become Silver rows."""

    name: str
    key: str
    month_column: str
    day: str
    month: Callable[[Column], Column]
    day_of: Callable[[str], Column]
    check: Callable[[DataFrame], DataFrame]
    features: Callable[[DataFrame], DataFrame]
    source: str
    dated: str | None = None


ENTITIES = [
    Entity("cdrs", "cdr_id", "call_month", "call_date", K.month_key, C.to_d, silver.checked_cdr, silver.cdr_features, "CDR_BATCH", "call_date"),
    Entity(
        "recharges", "recharge_id", "recharge_month", "recharge_month", lambda month: month, F.col, silver.checked_recharges,
        silver.recharge_features, "RECHARGE_BATCH",
    ),
]


def _sharing(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the keys; NULL is a key too."""
    wanted = keys.select(F.col(key).alias("__key")).distinct()
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("__key")), "left_semi")


def _months(rows: DataFrame, entity: Entity, day: Column) -> set[str]:
    """Months of the rows; they are taken from the days, which are few."""
    return {r[0] for r in rows.select(entity.day).distinct().select(entity.month(day)).distinct().collect()} - {None}


def refresh_silver(spark: SparkSession, cfg: RunConfig, entity: Entity, run: RunResult) -> list[str]:
    """Build the Silver months that the landed files not yet taken in touch; returns them.

    A row can win or lose against a row of equal id in another month.  So the months of all
    rows that share an id with a new row are touched, and each is built from all rows that
    share an id with one of its rows; the result is that of a run over everything landed.
    Of the files before, only ids and months are read, and then the rows of touched ids.
    """
    landing, taken = cfg.path("landing", entity.name), cfg.path("work", f"{entity.name}_taken")
    listed = files.list_files(spark, landing).where(F.col("path").endswith(".parquet")).select(files.FILE)
    first = not path_exists(spark, taken)
    if not first:
        listed = listed.join(spark.read.parquet(taken), files.FILE, "left_anti")
    new = listed.collect()  # names of files, as the scan of any table holds them
    run.detail[f"new_files_{entity.name}"] = len(new)
    if not new:
        run.rows_written[entity.name] = 0
        return []
    rows = read_table(spark, cfg.base, "landing", entity.name)
    if entity.dated:  # as the scan of the raw files
        rows = in_window(rows, entity.dated, cfg.window_start, cfg.window_end)
    landed_day, day = entity.day_of(entity.day), F.col(entity.day)  # as text, and typed by the check
    if first:
        touched = rows
    else:
        fresh = spark.read.schema(rows.schema).option("basePath", landing).parquet(*[files.literal(f["path"]) for f in new])
        touched = _sharing(rows, fresh, entity.key)
    months = sorted(_months(touched, entity, landed_day))
    # where no other month is left, all rows are wanted and need not be looked for
    whole = first or _months(rows, entity, landed_day) <= set(months)
    wanted = rows if whole else _sharing(rows, rows.where(entity.month(landed_day).isin(months)), entity.key)
    checked = entity.check(wanted.drop("file_date", "source_file"))
    work = cfg.path("work", f"{entity.name}_refreshed")
    run.rows_read[entity.name] = write_table(checked, work)
    good = spark.read.schema(checked.schema).parquet(work).where(F.col("reject_reason").isNull()).drop("reject_reason")
    good = good.where(entity.month(day).isin(months))
    path = cfg.path("silver", entity.name)
    if entity.name == "cdrs":
        built = clustered_cdr(good)
    else:
        built = silver.with_audit(entity.features(good), entity.source)
    run.rows_written[entity.name] = write_table(built, path, entity.month_column, dynamic=True, balanced=entity.name != "cdrs")
    # a month whose last rows lost against new ones has nothing that would replace it
    left = _months(good, entity, day)
    drop_partitions(spark, path, entity.month_column, [m for m in months if m not in left])
    remove(spark, work)
    spark.createDataFrame([tuple(f) for f in new], "path string, modified timestamp, bytes bigint").coalesce(1).write.mode("append").parquet(taken)
    return months


def refresh(spark: SparkSession, cfg: RunConfig) -> RunResult:
    """Take newly landed CDRs and recharges into Silver and Gold, and the customers as they were last extracted."""
    with tidy_shuffles(spark), audited(spark, cfg.path("control", "audit"), "refresh", debug=cfg.debug) as run:
        touched = {e.name: refresh_silver(spark, cfg, e, run) for e in ENTITIES}
        customers = silver.silver_customers(files.read_extract(spark, cfg.path("landing", "customers")))
        run.rows_written["customers"] = write_table(silver.with_audit(customers, "CUSTOMER_DB"), cfg.path("silver", "customers"))
        run.detail["months"] = touched
        if months := touched["cdrs"]:
            cdr = read_table(spark, cfg.base, cfg.sink_folder, "cdrs").where(F.col("call_month").isin(months))
            usage = cfg.path("work", "usage_daily")
            run.rows_written["usage_daily"] = write_table(gold.usage_daily(cdr), usage, "call_month", dynamic=True)
            present = {r[0] for r in cdr.select("call_month").distinct().collect()}
            drop_partitions(spark, usage, "call_month", [m for m in months if m not in present])
        run.rows_written |= publish(spark, cfg)
    return run
