"""Per-micro-batch tables, written so that a replayed micro-batch replaces its own output.

Closed micro-batches are folded into larger tables, so that a ledger that runs for long lists few
folders (:func:`fold`); :func:`everything` reads both.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType


def put(df: DataFrame, base: str, batch_id: int, folders: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*folders).parquet(f"{base}/batch_id={batch_id}")


def get(spark: SparkSession, base: str, batch_id: int, schema: StructType) -> DataFrame:
    """What micro-batch ``batch_id`` wrote; empty before the first one."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/batch_id={batch_id}")


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def newest(spark: SparkSession, base: str) -> int:
    """The last micro-batch that wrote below ``base``; -1 before the first one."""
    names = _listed(spark, base)
    return max((int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")), default=-1)


def forget(spark: SparkSession, base: str, batch_id: int) -> None:
    """Remove what micro-batch ``batch_id`` wrote below ``base``, if it is there."""
    if batch_id >= 0:
        _remove(spark, f"{base}/batch_id={batch_id}")


def _remove(spark: SparkSession, path: str) -> None:
    place, files = _folder(spark, path)
    files.delete(place, True)


#: Closed micro-batches that are folded into one table at a time.
EVERY = 64

_Span = tuple[int, int]


def _folded(base: str) -> str:
    return f"{base}.folded"


def _listed(spark: SparkSession, path: str) -> list[str]:
    place, files = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def _parts(spark: SparkSession, base: str) -> tuple[list[int], list[_Span], list[_Span]]:
    """Micro-batches on their own, tables of folded ones, and tables that a larger one covers.

    A micro-batch or table within the range of a larger one is done with, also where it still lies
    there because a fold was cut short or a reader may be at it.
    """
    names = _listed(spark, base)
    numbers = sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    made = [n for n in _listed(spark, _folded(base)) if not n.startswith("_")]
    spans = sorted((tuple(map(int, n.split("-"))) for n in made), key=lambda s: (s[0], -s[1]))
    kept: list[_Span] = []
    covered: list[_Span] = []
    for span in spans:
        (covered if kept and span[1] <= kept[-1][1] else kept).append(span)
    loose = [n for n in numbers if not any(first <= n <= last for first, last in kept)]
    return loose, kept, covered


def _rows(
    spark: SparkSession, base: str, schema: StructType, loose: Sequence[int], spans: Sequence[_Span]
) -> DataFrame:
    parts = []
    if loose:
        paths = [f"{base}/batch_id={n}" for n in loose]
        parts.append(spark.read.schema(schema).option("basePath", base).parquet(*paths))
    if spans:
        numbered = StructType([*schema.fields, StructField("batch_id", IntegerType())])
        parts.append(spark.read.schema(numbered).parquet(*[f"{_folded(base)}/{a}-{b}" for a, b in spans]))
    return reduce(DataFrame.unionByName, parts)


def everything(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """All micro-batches, folded or not; nothing when none has run yet."""
    loose, spans, _ = _parts(spark, base)
    if not loose and not spans:
        return spark.createDataFrame([], schema)
    return _rows(spark, base, schema, loose, spans)


def fold(
    spark: SparkSession,
    base: str,
    batch_id: int,
    schema: StructType,
    every: int = EVERY,
    keep: int | None = None,
) -> None:
    """At the end of micro-batch ``batch_id``: keep the number of folders below ``base`` small.

    Closed micro-batches (all but the last two, which a replay may write again or start from) are
    folded into one table when ``every`` of them lie there; ``every`` tables of one size become a
    larger one. So a row is rewritten as often as its table has levels, and some ``every`` folders
    for each level are listed. A table appears by a rename, and what it covers is removed at the next
    fold only: a fold that is cut short is made again, and readers find their files meanwhile. With
    ``keep``, tables that are older than so many micro-batches are removed.
    """
    if every < 2:
        raise ValueError(f"at least two micro-batches are folded at a time, got {every}")
    loose, spans, covered = _parts(spark, base)
    closed = [n for n in loose if n <= batch_id - 2]
    if len(closed) < every:
        return
    own = _listed(spark, base)
    for n in (int(x.removeprefix("batch_id=")) for x in own if x.startswith("batch_id=")):
        if any(first <= n <= last for first, last in spans):
            forget(spark, base, n)
    for first, last in covered:
        _remove(spark, f"{_folded(base)}/{first}-{last}")
    if keep is not None:
        for span in [s for s in spans if s[1] < batch_id - keep]:
            _remove(spark, f"{_folded(base)}/{span[0]}-{span[1]}")
            spans.remove(span)
    taken: list[_Span] = []
    size = len(closed)
    while True:
        level = [s for s in spans if s not in taken and s[1] - s[0] + 1 < size * every]
        if len(level) + 1 < every:
            break
        taken += level
        size = sum(b - a + 1 for a, b in taken) + len(closed)
    first = min([closed[0], *(a for a, _ in taken)])
    staged = f"{_folded(base)}/_staged-{batch_id}"
    # Adaptive execution packs the many small files into few.
    rows = _rows(spark, base, schema, closed, taken).hint("rebalance")
    rows.write.mode("overwrite").parquet(staged)
    source, files = _folder(spark, staged)
    target, _ = _folder(spark, f"{_folded(base)}/{first}-{closed[-1]}")
    if not files.rename(source, target):
        raise OSError(f"could not rename {staged}")
