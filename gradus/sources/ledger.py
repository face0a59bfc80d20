"""Result rows stored run by run, so that work which stopped can go on.

Each part of a run is one folder that is written as a whole or not at all: writing it again
replaces it alone, and a part counts as finished only once its writer has committed.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

# Written by a committed job. Fixed value.
COMMITTED = "_SUCCESS"


class Ledger:
    """Parts of runs below one folder, as ``run=…/part=…``. The folder must be one that all executors see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _place(self, run: str) -> str:
        if not run:
            raise ValueError("a run needs a name")
        return f"{self.folder}/run={quote(str(run), safe='')}"

    def place(self, run: str, part: int) -> str:
        """Folder of one part."""
        return f"{self._place(run)}/part={int(part)}"

    def append(self, run: str, part: int, rows: DataFrame) -> None:
        """Store the rows of one part. A second time replaces what the first one stored, and nothing else."""
        rows.write.mode("overwrite").parquet(self.place(run, part))

    def finished(self, run: str) -> list[int]:
        """Numbers of the parts whose rows are all there."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(self._place(run))
        files = place.getFileSystem(conf)
        if not files.exists(place):
            return []
        parts = [f.getPath() for f in files.listStatus(place) if f.isDirectory() and f.getPath().getName().startswith("part=")]
        done = [p for p in parts if files.exists(jvm.org.apache.hadoop.fs.Path(p, COMMITTED))]
        return sorted(int(p.getName().removeprefix("part=")) for p in done)

    def part(self, run: str, part: int) -> DataFrame:
        return self.spark.read.parquet(self.place(run, part))

    def rows(self, run: str) -> DataFrame | None:
        """All finished parts of a run with their numbers as ``part``; None if there are none."""
        done = self.finished(run)
        if not done:
            return None
        return self.spark.read.option("basePath", self._place(run)).parquet(*[self.place(run, p) for p in done])
