"""Session helpers: a local session for tests and the lineage cut for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_session(cores: str | int = "*", app: str = "roadloom", **conf: str) -> SparkSession:
    """Session for tests and benches on one machine; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """This session's checkpoint folder, set from ``spark.checkpoint.dir`` if it isn't yet.

    Only a session on one machine (master ``local``) may go without that
    setting; it then uses a temporary folder.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and (context.master == "local" or context.master.startswith("local[")):
            shared = tempfile.mkdtemp(prefix="roadloom-ckpt-")
        if not shared:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage, so lost executors do not replay the loop."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


FILE_ROWS = 20_000


def stored(df: DataFrame) -> DataFrame:
    """Like :func:`cut_lineage`, as Parquet in the checkpoint folder.

    A checkpoint holds rows as they are in memory. Routes repeat a few names and small
    numbers, which compressed columns hold in a fraction of that. Files are kept to
    ``FILE_ROWS`` rows, since a scan makes tasks by bytes and few bytes hold many rows.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of a loop, written to the checkpoint folder and removed at its end.

    A checkpointed table keeps the size that was estimated for its plan, and the
    estimate for a join is a product, so over the rounds of a loop it grows to
    numbers of millions of digits that take longer to plan with than the work
    itself. A written table has the size of its files. What outlives the loop must
    be cut from it first (:func:`cut_lineage`).
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark)}/scratch-{uuid.uuid4().hex}"
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.read_as(df, df.schema)

    def read_as(self, df: DataFrame, schema: StructType) -> DataFrame:
        """The same, read with another schema of the same storage form."""
        path = f"{self.folder}/{self.count}"
        self.count += 1
        df.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def free(self, first: int, last: int) -> None:
        """Remove the tables written as number ``first`` up to, not including, ``last``."""
        for number in range(first, last):
            self._remove(f"{self.folder}/{number}")

    def _remove(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self._remove(self.folder)


BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; beyond the bound the join shuffles.

    Meant for narrow rows over a materialised table (see :func:`cut_lineage`),
    where counting up to the bound is cheap.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
