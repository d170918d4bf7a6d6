"""Relational sources through Spark's own JDBC reader, split into parallel range reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.sources.files import NO_FILTER
from tableferry.specs import LoadSpec

# The address form and the driver class of each source.
_URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}?useSSL=false&tinyInt1isBit=false&zeroDateTimeBehavior=convertToNull",
    "postgres": "jdbc:postgresql://{host}:{port}/{database}",
    "hologres": "jdbc:postgresql://{host}:{port}/{database}",
    "redshift": "jdbc:redshift://{host}:{port}/{database}",
    "maxcompute": "jdbc:odps:{host}?project={database}&useProjectTimeZone=true",
    "hive": "jdbc:hive2://{host}:{port}/{database}",
}
_DRIVERS = {
    "mysql": "com.mysql.cj.jdbc.Driver",
    "postgres": "org.postgresql.Driver",
    "hologres": "org.postgresql.Driver",
    "redshift": "com.amazon.redshift.jdbc42.Driver",
    "maxcompute": "com.aliyun.odps.jdbc.OdpsDriver",
    "hive": "org.apache.hive.jdbc.HiveDriver",
}

# Read partitions of a table that is split without a number given.
DEFAULT_PARTITIONS = 16


@dataclass(frozen=True)
class JdbcSource:
    """Where the source is.  The password is kept out of the URL and out of the representation.

    Every read partition holds a connection open.  A read that asks for more than
    ``max_connections`` is an error: fewer would be slower than asked for, more endanger the source.
    """

    dialect: str
    host: str
    port: int
    database: str
    user: str = ""
    password: str = field(default="", repr=False)
    options: tuple[tuple[str, str], ...] = ()
    max_connections: int = 64

    def checked(self, partitions: int) -> int:
        if not 1 <= partitions <= self.max_connections:
            raise ValueError(f"{partitions} read partitions; max_connections is {self.max_connections}")
        return partitions

    @property
    def url(self) -> str:
        return _URLS[self.dialect].format(host=self.host, port=self.port, database=self.database)

    def reader_options(self) -> dict[str, str]:
        own = {"url": self.url, "driver": _DRIVERS[self.dialect], "fetchsize": "10000"}
        if self.user:
            own |= {"user": self.user, "password": self.password}
        return own | dict(self.options)


@dataclass(frozen=True)
class KeySplit:
    """Equal-width ranges of a numeric or date key.  Take the bounds from ``key_bounds``: rows
    outside them all land in the first or last range."""

    column: str
    lower: int | str
    upper: int | str
    partitions: int

    def reader_options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower), "upperBound": str(self.upper),
                "numPartitions": str(self.partitions)}


def filtered(table: str, source_where: str = "") -> str:
    """A table, or its rows by a condition in the source's own SQL, as what to read from."""
    return f"(select * from {table} where {source_where}) filtered_rows" if source_where.strip() else table


def key_bounds(spark: SparkSession, source: JdbcSource, table: str, column: str, source_where: str = "") -> tuple:
    """The smallest and largest key; the source computes them and sends one row."""
    name = quoted(column, source.dialect)
    query = f"select min({name}) as lo, max({name}) as hi from {filtered(table, source_where)}"
    row = spark.read.format("jdbc").options(**source.reader_options()).option("query", query).load().first()
    return (row["lo"], row["hi"])


def read_jdbc(spark: SparkSession, source: JdbcSource, table: str, *, split: KeySplit | None = None,
              predicates: Sequence[str] = (), where: str = NO_FILTER, load: LoadSpec = LoadSpec(),
              key: Sequence[str] = (), source_where: str = "") -> DataFrame:
    """A relational table, read in parallel by key ranges or by ready-made conditions.

    ``load.split`` is on unless turned off: without a ``split`` one is made from the single column of
    the primary ``key`` and its bounds, and a table without such a key is an error, as one connection
    would read all of it.

    ``predicates`` gives one read partition per condition (see ``range_predicates``).  The filter
    and the columns selected later are pushed to the source by Spark.

    ``where`` is a Spark expression, of which Spark pushes what it can translate.  ``source_where`` is in the source's own
    SQL and always runs there, bounds included.
    """
    rows = filtered(table, source_where)
    options = source.reader_options()
    if load.split and not predicates and split is None:
        if len(key) != 1:
            raise ValueError(f"{table}: no single-column key to split the read by; give split or predicates, or turn load.split off")
        lower, upper = key_bounds(spark, source, table, key[0], *([source_where] if source_where else []))
        # An empty table has no bounds, and nothing to split.
        split = KeySplit(key[0], lower, upper, load.read_partitions or DEFAULT_PARTITIONS) if lower is not None else None
    if predicates and load.split:
        source.checked(len(predicates))
        url, properties = options.pop("url"), options
        df = spark.read.jdbc(url, rows, predicates=list(predicates), properties=properties)
    else:
        if split is not None and load.split:
            options |= split.reader_options()
            options["numPartitions"] = str(source.checked(load.read_partitions or split.partitions))
        df = spark.read.format("jdbc").options(**options).option("dbtable", rows).load()
    return df.where(F.expr(where))


def list_tables_query(dialect: str, schema: str = "") -> str:
    """A query whose first column holds the names of all tables of the source."""
    if dialect in ("postgres", "hologres", "redshift"):
        return f"select tablename from pg_tables where schemaname = {literal(schema)}"
    if dialect == "mysql":
        return "select table_name from information_schema.tables where table_schema = database()"
    if dialect in ("hive", "maxcompute"):
        # Their SHOW TABLES can't stand in a FROM clause, where the reader puts every query.
        raise ValueError(f"{dialect} tables are listed through the catalog: it has no table of tables to query")
    raise ValueError(f"no query lists the tables of {dialect!r}; one of {', '.join(_URLS)}")


def literal(value: object) -> str:
    """A value in an SQL text: numbers as they are, quotes doubled in everything else."""
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def quoted(column: str, dialect: str = "") -> str:
    """A column name in an SQL text; without a dialect as Spark reads it."""
    if dialect in ("postgres", "hologres", "redshift"):
        return '"' + column.replace('"', '""') + '"'
    return "`" + column.replace("`", "``") + "`"


def list_source_tables(spark: SparkSession, source: JdbcSource, schema: str = "") -> list[str]:
    """The names of all tables of a source; an error stays an error, never an empty list."""
    query = list_tables_query(source.dialect, schema)
    names = spark.read.format("jdbc").options(**source.reader_options()).option("query", query).load()
    return [r[0] for r in names.toLocalIterator()]


def equal_cuts(lower: int | date, upper: int | date, partitions: int) -> list:
    """Cut points of equally wide ranges between the bounds of a whole-number or date key."""
    whole = upper - lower
    steps = (whole.days if isinstance(whole, timedelta) else whole) + 1
    width = -(-steps // partitions)
    step = timedelta(days=1) if isinstance(whole, timedelta) else 1
    return [lower + i * width * step for i in range(1, partitions) if i * width < steps]


def split_sizes(df: DataFrame, column: str, conditions: Sequence[str]) -> DataFrame:
    """How many rows each of the conditions of a read would carry, and their first and last key.

    Run it on an earlier copy before a large read: conditions far apart in size call for
    ``quantile_cuts``.  The conditions are the ones the reader is given, so there is no second
    formula.  At most one row per condition leaves a task.
    """
    number = F.coalesce(*[F.when(F.expr(c), F.lit(i)) for i, c in enumerate(conditions)])
    return (df.groupBy(number.alias("split"))
            .agg(F.count("*").alias("n"), F.min(column).alias("first_key"), F.max(column).alias("last_key")))


def quantile_cuts(df: DataFrame, column: str, partitions: int) -> list:
    """Cut points that give about equally many rows per range, whatever the spread of the keys."""
    wanted = [i / partitions for i in range(1, partitions)]
    found = df.select(F.percentile_approx(column, wanted, 10000).alias("cuts")).first()["cuts"] or []
    return sorted(set(found))


def range_predicates(column: str, cuts: Sequence, dialect: str = "") -> list[str]:
    """SQL conditions of which every row, NULL keys included, satisfies exactly one."""
    if not cuts:
        return [NO_FILTER]
    name, points = quoted(column, dialect), [literal(c) for c in cuts]
    middle = [f"{name} >= {a} and {name} < {b}" for a, b in zip(points, points[1:])]
    return [f"{name} < {points[0]} or {name} is null", *middle, f"{name} >= {points[-1]}"]


def read_evenly(spark: SparkSession, source: JdbcSource, table: str, key: Sequence[str], *, where: str = NO_FILTER, source_where: str = "",
                load: LoadSpec = LoadSpec()) -> DataFrame:
    """A table read by ranges of about equally many rows of any key: several columns, text, skewed values.

    The source is asked for counts first, some aggregate queries over the key; ``read_jdbc`` with one whole-number key
    only asks for its bounds, and takes ranges of equal width.
    """
    from tableferry.sources.even_split import even_conditions

    def ask(query: str) -> list[tuple]:
        return [tuple(r) for r in spark.read.format("jdbc").options(**source.reader_options()).option("query", query).load().collect()]

    partitions = source.checked(load.read_partitions or DEFAULT_PARTITIONS)
    found = even_conditions(ask, filtered(table, source_where), key, partitions, source.dialect)
    return read_jdbc(spark, source, table, predicates=found, where=where, load=load, source_where=source_where)
