"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone; no text counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds by bytes as well, since texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # where stored frames lie
_OWN: dict[str, str] = {}  # folders of local applications


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one the cluster names. Where none is named, a
    local session gets a folder of its own; on a cluster that would lose rows, so it is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="checkpoints-")
    return _OWN[context.applicationId]


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts lineage: what follows survives the loss of any executor without recomputing what
    came before, and a frame used several times is computed once.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[frame] = path
    return frame


def forget(*frames: DataFrame | None) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for frame in frames:
        path = _FOLDERS.pop(frame, None) if frame is not None else None
        if path is not None:
            jvm = frame.sparkSession.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """Without columns that an operator is about to add; names differ in any case."""
    mine = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in mine])


def most_frequent(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the greatest counts: as many as possible up to `most`, all or none of
    those with like counts. The bar is found in a histogram of some hundred rows, so nothing
    is sorted and no task sends its own greatest rows."""
    level = F.floor(F.log2(count) * 16).cast("int")
    sizes = df.groupBy(level.alias("level")).count().collect()
    bar, kept = None, 0
    for at, n in sorted(((r[0], r[1]) for r in sizes), reverse=True):
        kept += n
        if kept > most:
            break
        bar = at
    return df.where(F.lit(False) if bar is None else level >= bar)
