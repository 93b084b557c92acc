"""Names of landing files, and an index of them that remembers what it saw.

Spark's file index lists a folder into the driver's JVM for any read.  From
there the names go to Spark in chunks: they never become Python objects, and a
long list becomes a Parquet dataset.

Files never leave the landing folder, so its list grows with history.  An index
keeps the last list, sorted, with the number of the update in which each name
was first seen; an update joins the new list with it once, and what a run has
to look at is what is new.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import work_dir
from ..sinks.files import delete_path, read_version, write_version
from ..sinks.ledger import path_missing

NAMES_SCHEMA = StructType([StructField("path", StringType(), False),
                           StructField("file_key", StringType(), False)])
#: Names handed from the driver's JVM to Spark at a time (some 200 bytes each).
CHUNK = 100_000


def file_key_col(path_col: str = "_file") -> Column:
    """Join key of a file: its encoded URI with ``scheme:///`` folded to
    ``scheme:/`` (the form ``_metadata.file_path`` reports)."""
    return F.regexp_replace(F.col(path_col), r"^([A-Za-z][A-Za-z0-9+.-]*:)//(/)", "$1$2")


def list_landing(spark: SparkSession, landing_dir: str, chunk: int = CHUNK) -> DataFrame:
    """``path`` and ``file_key`` of the files in ``landing_dir`` that have an
    extension (a glob lists several folders); none if it is not there.

    Zero-byte markers are included.  ``path`` is decoded for reading,
    ``file_key`` is the encoded URI that ``_metadata.file_path`` reports for the
    same file.  Lists of more than ``chunk`` names are staged."""
    jvm = spark.sparkContext._jvm
    try:
        found = spark.read.format("binaryFile").load(landing_dir)._jdf.inputFiles()
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        return spark.createDataFrame([], NAMES_SCHEMA)

    def part(start: int) -> DataFrame:
        rows = spark._jsparkSession.createDataset(uris.subList(start, min(start + chunk, count)),
                                                  jvm.org.apache.spark.sql.Encoders.STRING())
        uri = DataFrame(rows.toDF(), spark).select(F.col("value").alias("uri"))
        # url_decode takes a plus sign for a blank
        path = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
        names = uri.select(F.coalesce(path, F.lit("")).alias("path"), F.coalesce(file_key_col("uri"), F.lit("")).alias("file_key"))
        return names.where(F.contains(F.substring_index("path", "/", -1), F.lit(".")))

    uris = jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found))
    count = uris.size()
    if count <= chunk:
        return part(0)
    staged = work_dir(spark, "listing")
    for start in range(0, count, chunk):
        part(start).write.mode("append").parquet(staged)
    return spark.read.schema(NAMES_SCHEMA).parquet(staged)


_SNAPSHOT = StructType([*NAMES_SCHEMA.fields, StructField("seen", LongType())])


class LandingIndex:
    """The names of a landing folder as of the last update, kept at ``path``.

    An update writes a new snapshot beside the last one and then points to it;
    a process that ends in between leaves the last one in force.  One process
    at a time may update an index."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def version(self) -> int:
        """Number of the last update; 0 before the first."""
        found = read_version(self.spark, f"{self.path}/current")
        return int(found[1]) if found else 0

    def _snapshot(self, version: int) -> str:
        return f"{self.path}/snapshot-{version}"

    def names(self) -> DataFrame:
        """``path``, ``file_key`` and ``seen`` (update of first sight) of all files."""
        version = self.version
        if not version:
            return self.spark.createDataFrame([], _SNAPSHOT)
        return self.spark.read.schema(_SNAPSHOT).parquet(self._snapshot(version))

    def new(self) -> DataFrame:
        """The names that the last update saw first."""
        return self.names().where(F.col("seen") == self.version)

    def update(self, landing_dir: str, chunk: int = CHUNK) -> DataFrame:
        """List the folder again; returns the names not seen before.  Names
        that are gone leave the index."""
        last = self.version
        listed = list_landing(self.spark, landing_dir, chunk)
        known = self.names().select("path", F.col("seen").alias("known"))
        (listed.join(known, "path", "left")
         .select("path", "file_key", F.coalesce("known", F.lit(last + 1)).cast("long").alias("seen"))
         .repartitionByRange("path").sortWithinPartitions("path")
         .write.mode("overwrite").parquet(self._snapshot(last + 1)))
        write_version(self.spark, f"{self.path}/current", str(last + 1))
        delete_path(self.spark, self._snapshot(last - 1))
        return self.new()
