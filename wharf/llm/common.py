"""What several of the training-data operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wharf.plans.joins import lookup
from wharf.session import configure, work_folder

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and
#: carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one window task should see; block counts are derived from it.
BLOCK_ROWS = 65_536


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: the library's own, and small batches for Python.

    Texts can be very long, so batches are bounded in bytes and not only in rows.
    """
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that were written since the innermost :func:`scratch` began, outermost first.
_WRITTEN: list[list[str]] = []


def stored(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` to the shared work folder once and read it back: lineage ends there.

    Spark removes shuffle files once the plan that made them is garbage; with ``free`` the driver
    collects it now, so that the files of a large step are gone before the next one starts.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    if free:
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """What is stored inside is removed at the end, but for what goes through the function given.

    That function (with the arguments of :func:`stored`) stores a result for whoever is around. Nothing that is used later may read, by its
    plan, what was stored inside in another way.
    """
    made: list[str] = []
    _WRITTEN.append(made)

    def keep(df: DataFrame, name: str, free: bool = False) -> DataFrame:
        out = stored(df, name, free)
        path = made.pop()
        if len(_WRITTEN) > 1:
            _WRITTEN[-2].append(path)
        return out

    try:
        yield keep
    finally:
        _WRITTEN.remove(made)
        files = spark._jvm.org.apache.hadoop.fs
        for path in made:
            place = files.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def exclusive_prefix(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    value: str,
    name: str,
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same ``keys``.

    Rows are ordered by ``bucket``, then by ``order``. A key is never one window: each bucket
    is, and the totals of the earlier buckets (a small table) are joined to it. Keys and
    bucket must not be null.
    """
    keys = list(keys)
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        *keys, bucket, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__base")
    )
    within = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = lookup(df, base, [*keys, bucket])
    return joined.withColumn(
        name, F.col("__base") + F.coalesce(F.sum(value).over(within), F.lit(0))
    ).drop("__base")
