"""Where tables are written to and read from: files of any Spark format, or JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmart.schema import EXTRA_TABLES, PRIMARY_KEYS, TABLES, jdbc_column_types
from tillmart.sources.ranges import bounds, ends_query, histogram, range_predicates
from tillmart.sources.swap import staged
from tillmart.sources.versions import VERSIONS, Versions

FACT_SPLIT = "customer_id"  # dense, and with one customer per sale as good as a key


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of a folder's files, as the file system sums it up."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files.getContentSummary(path).getLength()


@dataclass(frozen=True)
class Target:
    """A database or folder that holds tables.

    ``location`` is a folder, or the URL for format ``jdbc``; ``options`` go to Spark as
    they are (driver, user, ``createTableOptions``, ``batchsize``, ``numPartitions`` …);
    ``prefix`` is put before each table name, for instance a database schema. With ``swap`` database
    tables are written beside the old ones, counted, and swapped, see :mod:`tillmart.sources.swap`.
    """

    location: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    prefix: str = ""
    swap: bool = False

    @property
    def is_jdbc(self) -> bool:
        return self.format == "jdbc"

    def versions(self, spark: SparkSession) -> Versions | None:
        """The versions of the tables below ``location``; a database has none."""
        return None if self.is_jdbc else Versions(spark, self.location)

    def version(self, name: str) -> Target:
        """The tables of one version."""
        return replace(self, location=f"{self.location}/{VERSIONS}/{name}")

    def current(self, spark: SparkSession) -> Target:
        """The published version: tables read from it belong together, also while a new one is loaded."""
        name = None if self.is_jdbc else Versions(spark, self.location).current()
        return self.version(name) if name else self

    def write_options(self, table: str) -> dict[str, str]:
        if not self.is_jdbc:
            return {"path": f"{self.location}/{self.prefix}{table}", **self.options}
        typed = jdbc_column_types(table)
        columns = {"createTableColumnTypes": typed} if typed else {}
        return {"url": self.location, "dbtable": f"{self.prefix}{table}", **columns, **self.options}

    def write(self, df: DataFrame, table: str) -> int:
        """Replace the table and return the number of rows written, without a second pass over ``df``."""
        if not (self.is_jdbc and self.swap):
            return self._save(df, table)
        with staged(self, df.sparkSession) as tables:
            rows = tables.write(df, table, self.write_as)
            tables.publish()
        return rows

    def write_as(self, df: DataFrame, table: str, name: str) -> int:
        """Write the table under another name."""
        return self._save(df, table, {"dbtable": name})

    def _save(self, df: DataFrame, table: str, more: dict[str, str] | None = None) -> int:
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        observed.write.format(self.format).mode("overwrite").options(**{**self.write_options(table), **(more or {})}).save()
        return seen.get["rows"]

    def read(self, spark: SparkSession, table: str, partitions: int | None = None, stored_as: str | None = None) -> DataFrame:
        """Scan a table; star tables come over JDBC in ``partitions`` ranges of a key, and may be stored
        under another name there."""
        if self.is_jdbc:
            split = PRIMARY_KEYS.get(table, FACT_SPLIT if table in TABLES else None)
            return scan_jdbc(spark, self.location, stored_as or f"{self.prefix}{table}", self.options, split, partitions)
        reader = spark.read.format(self.format).options(**self.options)
        known = {**TABLES, **EXTRA_TABLES}
        if table in known:  # a known table needs no look into its files
            reader = reader.schema(known[table])
        return reader.load(f"{self.location}/{self.prefix}{table}")


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    options: dict[str, str],
    split: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read a database table, in parallel if a numeric ``split`` column is named.

    The ranges of ``split`` hold about equally many rows, see :mod:`tillmart.sources.ranges`. Only counts
    of key intervals come back from the database before the rows do.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("dbtable", table).load()

    def ask(query: str) -> list[tuple[int, int]]:
        return [tuple(r) for r in reader.option("query", query).load().collect()]

    low, high = ask(ends_query(table, split))[0]
    if low is None:
        return reader.option("dbtable", table).load()
    tasks = partitions or spark.sparkContext.defaultParallelism
    cuts = bounds(histogram(ask, table, split, int(low), int(high), tasks), tasks)
    return spark.read.jdbc(url, table, predicates=range_predicates(split, cuts), properties=options)
