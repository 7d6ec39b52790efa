"""Document and tabular sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cleanroom.functions.masking import export_frame
from cleanroom.plans.config import EXPORT_HEADERS, EXPORT_TABLES


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, without another pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


#: In a collection's folder, the file that names the version that counts.
MANIFEST = "current"


class Collection:
    """A folder of document versions, of which a manifest names the one that counts.

    A new version is written whole beside the old one; moving the manifest is the one step
    that replaces it, and file systems do that at once or not at all.  A run that is lost
    before leaves the old version in place, and a later run removes what was left.
    """

    def __init__(self, spark: SparkSession, target: str, name: str):
        self.spark, self.path = spark, f"{target.rstrip('/')}/{name}"
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._at(self.path).getFileSystem(self._conf)

    def _at(self, path: str):
        return self._jvm.Path(path)

    def current(self) -> str | None:
        """The folder of the version that counts, if there is any."""
        manifest = self._at(f"{self.path}/{MANIFEST}")
        if not self._files.exists(manifest):
            return None
        return f"{self.path}/{self.spark.read.text(f'{self.path}/{MANIFEST}').first().value}"

    def stage(self) -> str:
        return f"{self.path}/version-{uuid.uuid4().hex}"

    def swap(self, staged: str | None) -> None:
        """Make ``staged`` the version that counts; nothing is left without one."""
        if staged is None:
            self._files.delete(self._at(self.path), True)
            return
        fresh = self._at(f"{self.path}/.{MANIFEST}-{uuid.uuid4().hex}")
        out = self._files.create(fresh, True)
        out.write(staged.rsplit("/", 1)[1].encode())
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self._jvm.Options.Rename, 1)
        options[0] = self._jvm.Options.Rename.OVERWRITE
        context = self._jvm.FileContext.getFileContext(self._files.getUri(), self._conf)
        context.rename(self._files.makeQualified(fresh), self._files.makeQualified(self._at(f"{self.path}/{MANIFEST}")), options)
        for found in self._files.listStatus(self._at(self.path)):
            if found.getPath().getName() not in (MANIFEST, staged.rsplit("/", 1)[1]):
                self._files.delete(found.getPath(), True)


def write_documents(
    docs: dict[str, DataFrame], target: str, fmt: str = "json", **options
) -> dict[str, int]:
    """Replace each collection; returns documents per collection.

    ``fmt='json'`` keeps each collection as a :class:`Collection` below ``target``, so
    that a lost run leaves the documents that were there; no documents leave no
    collection.  Any other document format on the class path is given ``database`` and
    ``collection``.
    """
    written = {}
    for name, df in docs.items():
        out, seen = counted(df, f"documents_{name}")
        if fmt == "json":
            kept = Collection(df.sparkSession, target, name)
            staged = kept.stage()
            out.write.format(fmt).options(**options).option("ignoreNullFields", "false").save(staged)
            written[name] = seen.get["rows"]
            kept.swap(staged if written[name] else None)
        else:
            out.write.mode("overwrite").format(fmt).options(**options).option("database", target).option("collection", name).save()
            written[name] = seen.get["rows"]
    return written


def read_documents(spark: SparkSession, target: str, name: str, schema) -> DataFrame:
    """The documents of a collection as they count; none if it is not there."""
    folder = Collection(spark, target, name).current()
    return spark.read.schema(schema).json(folder) if folder else spark.createDataFrame([], schema)


def export_tables(
    tables: dict[str, DataFrame],
    target: str,
    names: list[str] | None = None,
    headers: dict[str, dict[str, str]] | None = None,
) -> dict[str, int]:
    """Masked export: one CSV directory with a header per table."""
    headers = EXPORT_HEADERS if headers is None else headers
    written = {}
    for name in names or EXPORT_TABLES:
        out, seen = counted(export_frame(tables[name], headers.get(name)), f"export_{name}")
        (
            out.write.mode("overwrite")
            .option("header", True)
            .option("escape", '"')
            .csv(f"{target.rstrip('/')}/{name}")
        )
        written[name] = seen.get["rows"]
    return written


def write_tables(tables: dict[str, DataFrame], target: str, fmt: str = "parquet") -> None:
    """(Re)build the typed tables below ``target``."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{name}")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()
