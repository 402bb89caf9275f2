"""Session helpers: local session for tests, lineage cutting, skew-safe join."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", app: str = "wayflux") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own configuration."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; set here only where the session names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="wayflux-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that loops keep short plans and survive lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    rows_per_task: int = 1_000_000,
    spread: list[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join whose hot keys on the `big` side are spread over several tasks.

    Keys with more than `rows_per_task` rows (at most rows / rows_per_task of them) get a
    salt count; `small` rows of those keys are repeated once per salt, so no row is lost.
    The salt is a hash of the `spread` columns (default: the whole row), hence the same
    when a task is run again. `counts` (on, `_n`) saves the count of `big` where it is known.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join keeps the big side; {how} is not supported")
    known = counts is not None
    counts = counts if known else big.groupBy(*on).agg(F.count("*").alias("_n"))
    hot = (
        counts.filter(F.col("_n") > rows_per_task)
        .select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    if known and hot.isEmpty():
        return big.join(small, on, how)
    left = big.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*(spread or big.columns)), F.col("_salts")).cast("int"))
    )
    right = (
        small.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))))
        .drop("_salts")
    )
    return left.drop("_salts").join(right, [*on, "_salt"], how).drop("_salt")
