"""Session helpers: shared folder for cut lineage, table access."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only a one-machine session (``local[..]``: tests, a laptop) that names none gets a local folder,
    set as checkpoint folder; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + os.path.join(tempfile.gettempdir(), "lettermill-shared")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


class Scratch:
    """Written tables that cut lineage; a lost executor costs no recomputation.

    ``drop`` removes a table that no later step reads, ``keep_only`` all but some; what is left goes
    when the session's file systems close.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
        self.paths: list[str] = []
        self.n = 0

    def _at(self, path: str):  # noqa: ANN202
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        if self.n == 1:
            fs, p = self._at(self.root)
            fs.deleteOnExit(p)
        self.paths.append(path)
        # the schema is given: no job is spent on reading footers
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lettermill_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame) -> None:
        self._delete(getattr(df, "_lettermill_path", None))

    def keep_only(self, *kept: DataFrame) -> None:
        still = {getattr(df, "_lettermill_path", None) for df in kept}
        for path in [p for p in self.paths if p not in still]:
            self._delete(path)

    def settle(self) -> None:
        """Shuffle files of writes that are over go now, not when the driver next collects its garbage."""
        self.spark.sparkContext._jvm.System.gc()

    def _delete(self, path: str | None) -> None:
        if path in self.paths:
            self.paths.remove(path)
            fs, p = self._at(path)
            fs.delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once an application, where they have no shared install."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="lettermill-ship-")) / "lettermill.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(out))
    _shipped.add(app)
