"""What the operators of this subpackage share: the shared folder, tables cut out of the lineage, words."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words; bytes.split() splits at the same six.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: A key is heavy with more than one part in HEAVY of the rows, and more than MANY of them.
HEAVY, MANY = 500, 100

#: Rows and bytes of an Arrow batch while a table is written. At Spark's 10,000 rows and 64 MB (which a buffer doubles
#: to while it grows) each task held some 100 MB of full sets beside the heap, and its Python worker as much.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

_folders: dict[str, str] = {}
#: Paths of tables by open scope, the innermost last.
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in the folder that driver and executors share.

    It is read from spark.checkpoint.dir. Only where that is unset and all runs on one machine (as in tests) a folder of
    our own is set; on a cluster a machine-local folder would scatter the tables, so there the setting is demanded. The
    folder is deleted when the application ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        top = spark.conf.get("spark.checkpoint.dir", None)
        if not top:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
            top = "file:///tmp/checkpoints"
            spark.conf.set("spark.checkpoint.dir", top)
        _folders[app] = f"{top.rstrip('/')}/cuewise-{app}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        return
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session is already down; the folder is scratch
        pass


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """What runs within sends its rows to Python in batches as small as ARROW says; the session's own sizes come back after it."""
    before = {k: spark.conf.get(k, None) for k in ARROW}
    try:
        for k, v in ARROW.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: cuts the lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables written within are deleted at the end, but for those given to the keep() that it hands out."""
    kept: list[str] = []
    _scopes.append([])
    try:
        yield lambda df: kept.append(df.scratch) or df
    finally:
        own = _scopes.pop()
        for path in own:
            if path not in kept:
                _remove(spark, path)
        if _scopes:
            _scopes[-1].extend(kept)


def bounded_broadcast(df: DataFrame, rows: int, most: int) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows (counted by the caller), else df as it is."""
    return F.broadcast(df) if rows <= most else df


def limit(n: int) -> int:
    """How many of n rows a key may have without being heavy; fewer than HEAVY keys have more."""
    return max(MANY, n // HEAVY)


def heavy(rows: DataFrame, on: list[str], n: int) -> DataFrame:
    """The heavy keys among n rows."""
    return rows.groupBy(*on).count().where(F.col("count") > limit(n)).select(*on)


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", hot: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """left joined with right, a table that has one row for each key (whole numbers); how: inner or left.

    Rows of heavy keys of left meet their few rows of right by broadcast (fewer than HEAVY of them) and are then dealt by a
    hash of the whole row, so no task gets all rows of a key. hot: the heavy keys if they are known; else left, a table, is
    counted. n: the rows of left, or more, if known.
    """
    if hot is None and n is None:
        n = left.count()
    if n is not None and n <= MANY:  # no key can be heavy
        return left.join(right, on, how)
    hot = heavy(left, on, n) if hot is None else hot
    keys = hot.select(*on).collect()  # fewer than HEAVY
    if not keys:
        return left.join(right, on, how)
    hot = F.broadcast(left.sparkSession.createDataFrame(keys, hot.select(*on).schema))
    more = [c for c in right.columns if c not in on]
    found = F.struct(*more, F.lit(True).alias("_in"))
    few = F.broadcast(hot.join(right.withColumn("_found", found).select(*on, "_found").join(hot, on, "left_semi"), on, "left").withColumn("_is_hot", F.lit(True)).withColumnRenamed("_found", "_near"))
    dealt = left.join(few, on, "left").withColumn("_deal", F.when(F.col("_is_hot"), F.xxhash64(*left.columns).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")))
    far = right.withColumn("_far", found).withColumn("_deal", F.lit(0).cast("long")).select(*on, "_deal", "_far")
    out = dealt.join(far, [*on, "_deal"], "left").withColumn("_got", F.coalesce("_near", "_far"))
    if how == "inner":
        out = out.where(F.col("_got").isNotNull())
    return out.select(*on, *[c for c in left.columns if c not in on], *[F.col("_got")[c].alias(c) for c in more])


def packed(docs: DataFrame, name: str = "row") -> DataFrame:
    """docs as one column, a struct of all of theirs, so that nothing added beside it can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text"):
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
