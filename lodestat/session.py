"""Sessions, and the shared folder in which intermediate tables survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A private folder is made only where none is named and the session runs on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lodestat-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class Kept:
    """Owner of intermediate tables: what is stored while it is open goes to it, and goes when it is closed.

    ``with Kept() as kept`` owns what its block stores, and deletes it at the end of the block unless ``kept.hold()`` was
    called; then ``close`` does. Owners nest: a table belongs to the innermost one that is open.
    """

    _open: list[Kept] = []

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []
        self._held = False

    def __enter__(self) -> Kept:
        Kept._open.append(self)
        return self

    def __exit__(self, kind, *_) -> None:
        Kept._open.pop()
        if kind is not None or not self._held:
            self.close()

    def hold(self) -> None:
        """Keep the tables beyond the block."""
        self._held = True

    def close(self) -> None:
        """Delete the tables. A second call does nothing."""
        while self.paths:
            spark, path = self.paths.pop()
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def note(spark: SparkSession, path: str) -> None:
    """Give what was written at ``path`` to the innermost owner that is open."""
    if Kept._open:
        Kept._open[-1].paths.append((spark, path))


def store(df: DataFrame, label: str = "table") -> DataFrame:
    """Compute a table once into reliable storage, cutting its lineage: columnar, compressed, read by column.

    Later uses read it back, also after executors are lost.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    note(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame], label: str = "table") -> DataFrame:
    """Store the table that ``build()`` gives as :func:`store` does, and delete all that was stored on the way to it."""
    path = fresh_path(spark, label)
    with Kept():
        df = build()
        df.write.parquet(path)
    note(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """As :func:`store`, for small tables."""
    return store(df, "small")
