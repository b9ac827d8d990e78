"""Publishing: the stamped detail table, run ids, versions of the table, files, the registry.

Every run writes its rows to a folder of its own. What the table is at a time is said by the
newest of small numbered files that name a run's folder; each is created under a number that
must be free, as a whole. So a reader finds a whole table at any time, whichever step a run
stops at, no folder is ever moved, and earlier runs stay where they are as the archive. A run's
id is reserved in the same way, so that runs at the same time have ids of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketspark.config import RunConfig, date_window
from basketspark.operators.indexing import global_index
from basketspark.runtime import counted, create_exclusive, exists, list_files, read_small

DETAIL_COLUMNS = (
    "MASTER_ID",
    "RECORD_ID",
    "TIME_PRD_VAL",
    "MODEL_TYPE",
    "MODEL_NAME",
    "SKU_X",
    "COUPON_X",
    "SKU_Y",
    "COUPON_Y",
    "BASKET_COUNT_XY",
    "BASKET_COUNT_X",
    "BASKET_COUNT_Y",
    "SKU_BASKET_COUNT_X",
    "SKU_BASKET_COUNT_Y",
    "SKU_SALES_X",
    "SKU_SALES_Y",
    "CONFIDENCE",
    "CVM_RANK",
    "START_DATE",
    "END_DATE",
)

REGISTRY_COLUMNS = (
    "master_id",
    "model_type",
    "model_subtype",
    "time_prd_val",
    "division",
    "table_name",
    "train_period",
    "predict_period",
    "start_predict_date",
    "record_count",
)

# Unique order of the published rows (the SKU pair alone can repeat across groups).
RECORD_ORDER = ("sku_X", "cvm_rank", "sku_Y", "coupon_key_X", "coupon_key_Y")


def _table_path(root: str, cfg: RunConfig) -> str:
    return f"{root.rstrip('/')}/tables/{cfg.table_name}"


def _ids_path(root: str, cfg: RunConfig) -> str:
    return f"{root.rstrip('/')}/ids/{cfg.table_name}"


def table_versions(spark: SparkSession, cfg: RunConfig, root: str) -> list[dict]:
    """The versions of the table, oldest first: number, folder, master_id, rows. One small file
    a run is listed and read."""
    folder = f"{_table_path(root, cfg)}/versions"
    return [json.loads(read_small(spark, f"{folder}/{name}")) for name in list_files(spark, folder) if name.isdigit()]


def read_table(spark: SparkSession, cfg: RunConfig, root: str, master_id: int | None = None) -> DataFrame:
    """The newest version of the table, or the one that a run published."""
    found = [v for v in table_versions(spark, cfg, root) if master_id is None or v["master_id"] == master_id]
    if not found:
        raise FileNotFoundError(f"no version of {cfg.table_name} below {root}" + ("" if master_id is None else f" by run {master_id}"))
    return spark.read.parquet(found[-1]["folder"])


def next_run_id(spark: SparkSession, cfg: RunConfig, root: str) -> int:
    """One more than the largest id that is reserved, registered or published (1 at first), so
    an id is never used again, wherever an earlier run stopped. Collects one value."""
    seen = [0, *(v["master_id"] for v in table_versions(spark, cfg, root))]
    seen += [int(name) for name in list_files(spark, _ids_path(root, cfg)) if name.isdigit()]
    registry = read_if_exists(spark, f"{root.rstrip('/')}/model_master")
    if registry is not None:
        seen.append(registry.agg(F.max("master_id").alias("m")).first()["m"] or 0)
    return int(max(seen)) + 1


def reserve_run_id(spark: SparkSession, cfg: RunConfig, root: str) -> int:
    """The next id, held by a file that only one run can create; on a conflict the one after."""
    master_id = next_run_id(spark, cfg, root)
    while not create_exclusive(spark, f"{_ids_path(root, cfg)}/{master_id:010d}"):
        master_id += 1
    return master_id


def number_records(ranked: DataFrame, counts: dict | None = None, ranged: bool = False) -> DataFrame:
    """Add ``record_id``: the position in the published order, numbered distributed. ``ranged`` rows
    were ranked in range partitions of ``sku_X``."""
    return global_index(ranked, list(RECORD_ORDER), "record_id", counts=counts, ranged=ranged)


def stamp_detail(ranked: DataFrame, master_id: int, cfg: RunConfig) -> DataFrame:
    """Run constants, a global record number and the fixed 20-column layout.

    Rows already numbered by ``number_records`` keep their ``record_id``.
    """
    lo, hi = date_window(cfg.start_date, cfg.period_days)
    numbered = ranked if "record_id" in ranked.columns else number_records(ranked)
    numbered = numbered.withColumnRenamed("record_id", "RECORD_ID")
    return numbered.select(
        F.lit(master_id).cast("bigint").alias("MASTER_ID"),
        F.col("RECORD_ID").cast("bigint").alias("RECORD_ID"),
        F.lit(cfg.period_days).alias("TIME_PRD_VAL"),
        F.lit(cfg.model_type).alias("MODEL_TYPE"),
        F.lit(cfg.model_name).alias("MODEL_NAME"),
        F.col("sku_X").alias("SKU_X"),
        F.col("coupon_X").alias("COUPON_X"),
        F.col("sku_Y").alias("SKU_Y"),
        F.col("coupon_Y").alias("COUPON_Y"),
        F.col("basket_count_XY").alias("BASKET_COUNT_XY"),
        F.col("basket_count_X").alias("BASKET_COUNT_X"),
        F.col("basket_count_Y").alias("BASKET_COUNT_Y"),
        F.col("sku_basket_count_X").alias("SKU_BASKET_COUNT_X"),
        F.col("sku_basket_count_Y").alias("SKU_BASKET_COUNT_Y"),
        F.col("sku_sales_X").alias("SKU_SALES_X"),
        F.col("sku_sales_Y").alias("SKU_SALES_Y"),
        F.col("confidence").alias("CONFIDENCE"),
        F.col("cvm_rank").alias("CVM_RANK"),
        F.lit(str(hi)).alias("START_DATE"),
        F.lit(str(lo)).alias("END_DATE"),
    )


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when it does not exist (any other error raises)."""
    return spark.read.parquet(path) if exists(spark, path) else None


def registry_row(spark: SparkSession, master_id: int, cfg: RunConfig, record_count: int) -> DataFrame:
    lo, hi = date_window(cfg.start_date, cfg.period_days)
    schema = (
        "master_id bigint, model_type string, model_subtype string, time_prd_val int, division string, "
        "table_name string, train_period int, predict_period int, start_predict_date string, record_count bigint"
    )
    row = (
        master_id,
        cfg.model_type,
        cfg.model_name,
        cfg.period_days,
        cfg.division,
        cfg.table_name,
        cfg.train_period_days,
        cfg.predict_period_days,
        str(hi),
        record_count,
    )
    return spark.createDataFrame([row], schema)


#: The steps of publishing, in order.
STEPS = ("rows", "version", "files", "registry")


def publish_steps(
    spark: SparkSession, detail: DataFrame, lists: DataFrame | None, master_id: int, cfg: RunConfig, root: str, csv_targets: tuple[str, ...] = ("QA", "DEV")
) -> Iterator[tuple[str, dict]]:
    """Publishes step by step: yields the name of each step once it is done, with the paths
    written and the rows published so far."""
    root = root.rstrip("/")
    table = _table_path(root, cfg)
    done: dict = {"paths": {}}
    folder = f"{table}/runs/{master_id:010d}-{uuid.uuid4().hex[:12]}"
    counts: dict[str, int] = {}
    with counted(detail, counts, "published") as rows:
        rows.write.mode("errorifexists").parquet(folder)
    done["rows"] = counts["published"]
    yield "rows", done
    versions = table_versions(spark, cfg, root)
    number = versions[-1]["number"] + 1 if versions else 1
    named = lambda n: json.dumps({"number": n, "folder": folder, "master_id": master_id, "rows": done["rows"]})
    while not create_exclusive(spark, f"{table}/versions/{number:010d}", named(number)):
        number += 1  # another run came first; this one is newer
    done["paths"]["table"] = folder
    if versions and versions[-1]["rows"]:  # an empty table is nothing to keep
        done["paths"]["archive"] = versions[-1]["folder"]
    yield "version", done
    if lists is not None:
        _, hi = date_window(cfg.start_date, cfg.period_days)
        for target in csv_targets:
            path = f"{root}/csv/{target}/CSV_Pipes_{hi}.csv"
            lists.write.mode("overwrite").option("header", True).csv(path)
            done["paths"][f"csv_{target}"] = path
    yield "files", done
    done["paths"]["registry"] = f"{root}/model_master"
    registry_row(spark, master_id, cfg, done["rows"]).write.mode("append").parquet(done["paths"]["registry"])
    yield "registry", done


def replace_table(
    spark: SparkSession, detail: DataFrame, lists: DataFrame | None, master_id: int, cfg: RunConfig, root: str, csv_targets: tuple[str, ...] = ("QA", "DEV")
) -> tuple[dict[str, str], int]:
    """``publish`` up to the registry row. Returns the paths written and the rows published."""
    for step, done in publish_steps(spark, detail, lists, master_id, cfg, root, csv_targets):
        if step == "files":
            return done["paths"], done["rows"]
    raise AssertionError("publishing has a step for the files")


def publish(
    spark: SparkSession, detail: DataFrame, lists: DataFrame | None, master_id: int, cfg: RunConfig, root: str, csv_targets: tuple[str, ...] = ("QA", "DEV")
) -> tuple[dict[str, str], int]:
    """Write the rows, name them the table's newest version, write the files, append the registry
    row. Returns the paths written and the rows published.

    Layout below ``root``: ``tables/<name>/runs/<id>-<unique>``, ``tables/<name>/versions/<number>``,
    ``ids/<name>/<id>``, ``csv/<target>/CSV_Pipes_<start>.csv``, ``model_master``.
    """
    *_, (_, done) = publish_steps(spark, detail, lists, master_id, cfg, root, csv_targets)
    return done["paths"], done["rows"]
