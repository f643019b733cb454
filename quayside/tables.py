"""Tables a load reads from or writes to: database tables over JDBC, catalog tables.

Both kinds answer the same calls: ``schema``, ``vendor_types``, ``read``,
``write`` and ``run``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.vendor import base_type
from .operators.align import align, quoted
from .operators.widths import text_limits, within
from .sinks.once import finish, forget, publish

# JDBC address of each database kind.
JDBC_URLS = {
    "MYSQL": "jdbc:mysql://{address}{path}?characterEncoding=utf8",
    "POSTGRESQL": "jdbc:postgresql://{address}{path}",
    "ORACLE": "jdbc:oracle:thin:@{address}{path}",
    "CLICKHOUSE": "jdbc:clickhouse://{address}{path}",
    "MSSQL": "jdbc:sqlserver://{address};databaseName={database};"
    "useBulkCopyForBatchInsert=true;applicationName={table};",
}

SLICED_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def sql_literal(value: Any, kind: str = "") -> str:
    """A bound of a slice as the database reads it; ``kind`` names the database."""
    if value is None or isinstance(value, bool):
        raise ValueError(f"no bound of a slice: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else repr(value)
    if isinstance(value, datetime):
        text = value.isoformat(" ")
        return f"TIMESTAMP '{text}'" if kind in ("ORACLE", "POSTGRESQL", "MYSQL", "") else f"'{text}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'" if kind in ("ORACLE", "POSTGRESQL", "MYSQL", "") else f"'{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def slice_predicates(column: str, starts: Sequence[Any], kind: str = "") -> list[str]:
    """Disjoint conditions that cover a table, from the first values of slices of equally many rows.

    A value that begins several slices holds a slice or more by itself and gets a condition of its own: no
    condition on this column cuts it further.  Rows without a value come with the first condition.
    """
    times: dict[Any, int] = {}
    for value in starts:
        if value is not None:
            times[value] = times.get(value, 0) + 1
    cuts: list[tuple[Any, bool]] = []  # a bound, and whether the value itself belongs above it
    for i, value in enumerate(sorted(times)):
        if i:
            cuts.append((value, True))
        if times[value] > 1:
            cuts.append((value, False))
    if not cuts:
        return ["1=1"]
    above = [f"{column} {'>=' if own else '>'} {sql_literal(v, kind)}" for v, own in cuts]
    below = [f"{column} {'<' if own else '<='} {sql_literal(v, kind)}" for v, own in cuts]
    between = [f"{a} AND {b}" for a, b in zip(above, below[1:])]
    return [f"({below[0]} OR {column} IS NULL)", *between, above[-1]]


@dataclass(frozen=True)
class JdbcTable:
    """A database table.  ``options`` go to Spark's JDBC source as they are."""

    kind: str
    host: str
    port: str
    database: str
    table: str
    user: str = ""
    password: str = field(default="", repr=False)
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.kind not in JDBC_URLS:
            raise ValueError(f"unknown database kind {self.kind!r}, not in {sorted(JDBC_URLS)}")

    @classmethod
    def from_params(cls, params: Mapping[str, Any], **options: str) -> JdbcTable:
        """Destination named by ``database-type``, ``host``, … ``destination-table``.

        ``jdbc-options`` (``name=value;…``) and ``driver`` go to Spark's JDBC source.
        """
        options = {**jdbc_options(params), **options}
        return cls(
            params["database-type"], params.get("host", ""), str(params.get("port", "")),
            params.get("database-name", ""), params.get("destination-table", ""),
            params.get("user", ""), params.get("password", ""), options,
        )

    @classmethod
    def from_config(cls, config: str, **options: str) -> tuple[JdbcTable, str]:
        """Source table and select list of ``user=…;password=…;…;table=…;select=a,b``."""
        # a password may hold "=", so only the first one separates
        c = dict(item.split("=", 1) for item in config.split(";") if item)
        options = {**jdbc_options({"driver": c.get("driver")}), **options}
        table = cls(
            c["databasetype"], c.get("host", ""), c.get("port", ""), c.get("schema", ""),
            c.get("table", ""), c.get("user", ""), c.get("password", ""), options,
        )
        return table, c.get("select", "*")

    @property
    def url(self) -> str:
        lead = ":" if self.kind == "ORACLE" else "/"
        path = self.database if self.database[:1] in ("/", ":") else lead + self.database
        return JDBC_URLS[self.kind].format(
            address=f"{self.host}:{self.port}",
            path=path, database=self.database, table=self.table,
        )

    @property
    def connection(self) -> dict[str, str]:
        given = {"url": self.url, "user": self.user, "password": self.password}
        if self.kind == "POSTGRESQL":
            # lets the server convert text bound to a column of another type
            given["stringtype"] = "unspecified"
        return {**given, **self.options}

    @property
    def probe(self) -> str:
        hint = " with(NoLock)" if self.kind == "MSSQL" else ""
        return f"SELECT * FROM {self.table}{hint} WHERE 1=0"

    def schema(self, spark: SparkSession) -> T.StructType:
        """Column names and types; fails if the table does not exist."""
        return (
            spark.read.format("jdbc").options(**self.connection).option("query", self.probe)
            .load().schema
        )

    def vendor_types(self, schema: T.StructType) -> dict[str, str]:
        """Column name -> the database's own type name, without its length."""
        return {
            f.name: base_type(f.metadata.get("jdbcClientType", f.dataType.simpleString()))
            for f in schema
        }

    def read(
        self,
        spark: SparkSession,
        columns: Sequence[str] = ("*",),
        partition_on: str | None = None,
        partitions: int | None = None,
        predicates: Sequence[str] | None = None,
        fetch_size: int = 10_000,
        equal_rows: bool = False,
    ) -> DataFrame:
        """The table's rows, read over ``partitions`` connections.

        ``partition_on`` names a numeric, date or timestamp column, best one
        with few rows per value; its range is asked of the database.  Rows
        without a value come over a connection of their own; a column that is
        NULL throughout deals nothing out and is refused.
        Ranges are of equal width; with ``equal_rows`` the database is asked for
        slices of equally many rows instead, for a column whose values crowd.
        ``predicates`` are disjoint conditions that together cover the table,
        one connection each.  Without either the whole table comes over one
        connection into one task, which has to be asked for by ``partitions=1``.
        """
        if equal_rows and partition_on and not predicates:
            n = partitions or spark.sparkContext.defaultParallelism
            rows = (
                spark.read.format("jdbc").options(**self.connection)
                .option("query", self.slice_starts(partition_on, n)).load().collect()
            )
            predicates = slice_predicates(partition_on, [r[0] for r in rows], self.kind)
        if predicates:
            df = self._by_predicates(spark, list(predicates), fetch_size)
        else:
            reader = (
                spark.read.format("jdbc").options(**self.connection)
                .option("dbtable", self.table).option("fetchsize", fetch_size)
            )
            if partition_on:
                low, high = self._range(spark, partition_on)
                if low is None:
                    raise ValueError(
                        f"{self.table} has no value in {partition_on}; use another column or predicates"
                    )
                ranged = reader.options(
                    **self.range_options(partition_on, low, high, partitions or spark.sparkContext.defaultParallelism)
                ).load()
                rest = self._by_predicates(spark, [f"{partition_on} IS NULL"], fetch_size)
                df = ranged.unionByName(rest)
                return df if list(columns) == ["*"] else align(df, columns)
            if partitions != 1:
                raise ValueError(
                    f"reading {self.table} needs partition_on or predicates; "
                    "pass partitions=1 to read it over one connection"
                )
            df = reader.load()
        return df if list(columns) == ["*"] else align(df, columns)

    def slice_starts(self, column: str, slices: int) -> str:
        """Query of the first value of each of ``slices`` slices of equally many rows."""
        numbered = f"SELECT {column} AS v, NTILE({slices}) OVER (ORDER BY {column}) AS slice FROM {self.table} WHERE {column} IS NOT NULL"
        return f"SELECT MIN(v) AS first_value FROM ({numbered}) numbered GROUP BY slice"

    def range_options(self, column: str, low: Any, high: Any, partitions: int) -> dict[str, str]:
        """Options of a read in ranges of a column, without the rows that have no value in it."""
        return {
            "dbtable": f"(SELECT * FROM {self.table} WHERE {column} IS NOT NULL) ranged",
            "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(partitions),
        }

    def _by_predicates(self, spark: SparkSession, predicates: list[str], fetch_size: int) -> DataFrame:
        properties = {k: v for k, v in self.connection.items() if k != "url"}
        properties["fetchsize"] = str(fetch_size)
        return spark.read.jdbc(self.url, self.table, predicates=predicates, properties=properties)

    def _range(self, spark: SparkSession, column: str) -> tuple[Any, Any]:
        query = f"SELECT MIN({column}) AS low_end, MAX({column}) AS high_end FROM {self.table}"
        row = (
            spark.read.format("jdbc").options(**self.connection).option("query", query)
            .load().first()
        )
        return row[0], row[1]

    def write_options(
        self, batch_size: int, parallelism: int | None, commit: str
    ) -> dict[str, str]:
        if commit not in ("partition", "batch"):
            raise ValueError(f"commit must be 'partition' or 'batch', got {commit!r}")
        options = {**self.connection, "dbtable": self.table, "batchsize": str(batch_size)}
        if parallelism:
            options["numPartitions"] = str(parallelism)
        if commit == "batch":
            options["isolationLevel"] = "NONE"
        return options

    def write(
        self,
        df: DataFrame,
        batch_size: int = 10_000,
        parallelism: int | None = None,
        commit: str = "partition",
        token: str | None = None,
    ) -> None:
        """Append rows by batched inserts; the columns must exist in the table.

        ``token`` does nothing here: rows that a database has taken come again if the call is repeated.

        Every running task has a connection, so the cores given to the job bound
        them.  ``parallelism`` asks Spark to narrow the whole load, its scan and
        conversion too, to so many tasks.  A partition is one transaction and a
        retried task starts clean; with ``commit="batch"`` every batch commits by
        itself, and a retried task repeats its batches.
        """
        options = self.write_options(batch_size, parallelism, commit)
        df.write.format("jdbc").options(**options).mode("append").save()

    def key_rows(self, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
        """The key columns of all rows, read in slices of the first that has an order to cut."""
        types = {f.name.lower(): f.dataType for f in self.schema(spark)}
        cut = next((k for k in keys if isinstance(types.get(k.lower()), SLICED_TYPES)), None)
        return self.read(spark, keys, partition_on=cut, partitions=None if cut else 1)

    def written(self, spark: SparkSession, token: str) -> bool:
        """A database keeps no tokens."""
        return False

    def forget(self, spark: SparkSession, *tokens: str) -> None:
        """Tokens leave nothing behind here."""

    def refresh(self, spark: SparkSession) -> None:
        """A database is read anew every time."""

    def run(self, spark: SparkSession, statements: Sequence[str], run_date: date | None) -> None:
        """Run statements on the database over one connection, committing after each.

        The run date is bound to ``?``; ClickHouse gets it as text.
        """
        connection = self._connect(spark)
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                self._execute(spark, connection, statement, run_date)
                connection.commit()
        finally:
            connection.close()

    def _execute(self, spark: SparkSession, connection: Any, statement: str, run_date: date | None) -> None:
        if "?" not in statement:
            call = connection.createStatement()
            call.execute(statement)
        elif run_date is None:
            raise ValueError(f"statement needs a run date: {statement}")
        elif self.kind == "CLICKHOUSE":
            call = connection.createStatement()
            call.execute(statement.replace("?", f"'{run_date.isoformat()}'"))
        else:
            call = connection.prepareCall(statement)
            for i in range(statement.count("?")):
                call.setDate(i + 1, spark._jvm.java.sql.Date.valueOf(run_date.isoformat()))
            call.execute()
        call.close()

    def _connect(self, spark: SparkSession) -> Any:
        """Connection made by Spark's own JDBC dialect, so ``--jars`` drivers are found."""
        jvm = spark._jvm
        jdbc = jvm.org.apache.spark.sql.execution.datasources.jdbc
        settings = jvm.PythonUtils.toScalaMap({**self.connection, "dbtable": self.table})
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        return dialect.createConnectionFactory(jdbc.JDBCOptions(settings)).apply(-1)


@dataclass(frozen=True)
class CatalogTable:
    """A table of the session catalog."""

    table: str

    def schema(self, spark: SparkSession) -> T.StructType:
        return spark.table(self.table).schema

    def vendor_types(self, schema: T.StructType) -> dict[str, str]:
        return {f.name: base_type(f.dataType.simpleString()) for f in schema}

    def read(
        self, spark: SparkSession, columns: Sequence[str] = ("*",), predicates: Sequence[str] | None = None, **_: Any
    ) -> DataFrame:
        """The table's rows; ``predicates`` are disjoint conditions, read one after the other into the same frame."""
        df = spark.table(self.table)
        if predicates:
            parts = [df.where(p) for p in predicates]
            df = parts[0]
            for part in parts[1:]:
                df = df.unionAll(part)
        return df if list(columns) == ["*"] else align(df, columns)

    def slice_starts(self, spark: SparkSession, column: str, slices: int, accuracy: int = 10_000) -> list[Any]:
        """The first value of each of ``slices`` slices of about equally many rows, by a mergeable quantile summary."""
        shares = [i / slices for i in range(slices)]
        summary = F.percentile_approx(quoted(column), shares, accuracy)
        return list(spark.table(self.table).agg(summary).first()[0] or [])

    def key_rows(self, spark: SparkSession, keys: Sequence[str]) -> DataFrame:
        """The key columns of all rows."""
        return spark.table(self.table).select(*map(quoted, keys))

    def write(self, df: DataFrame, token: str | None = None, **_: Any) -> None:
        """Append rows by column name; columns the rows lack are NULL.

        With a ``token`` the rows come in exactly once, however often the call is repeated, if the table is one of
        Parquet or ORC files without buckets; another table just gets them appended.
        """
        rows, place = self.fit(df), self.place(df.sparkSession) if token else None
        if place is None:
            rows.write.insertInto(self.table)
            return
        where, kind, parts = place
        for field_name, limit in text_limits(rows.schema, self.schema(df.sparkSession)).items():
            # what an insert checks, a write to the table's folder has to check by itself
            c = quoted(field_name)
            wide = F.raise_error(F.lit(f"{field_name} holds text longer than {limit}")).cast("string")
            cut = F.when(within(c, limit), F.substring(c, 1, limit)).otherwise(wide)
            rows = rows.withColumn(field_name, cut)
        publish(rows, where, token, parts, kind)
        self._see(df.sparkSession, parts)

    def _see(self, spark: SparkSession, parts: Sequence[str]) -> None:
        """Have the catalog look at files that were put into the table's folder."""
        if parts:
            spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.refresh(spark)

    def refresh(self, spark: SparkSession) -> None:
        """Let a session see rows that another one has written."""
        spark.catalog.refreshTable(self.table)

    def place(self, spark: SparkSession) -> tuple[str, str, list[str]] | None:
        """Folder, file format and partition columns, if rows can be put into the table's folder as files."""
        if spark.catalog.getTable(self.table).tableType not in ("MANAGED", "EXTERNAL"):
            return None
        told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {self.table} AS JSON").first()[0])
        kind = told.get("provider", "").lower()
        if kind not in ("parquet", "orc") or int(told.get("num_buckets") or 0) > 0 or "location" not in told:
            return None
        return told["location"], kind, list(told.get("partition_columns") or [])

    def written(self, spark: SparkSession, token: str) -> bool:
        """Whether the rows of a token are in the table; a write that was cut short while its files moved is finished."""
        place = self.place(spark)
        if place is None or not finish(spark, place[0], token):
            return False
        self._see(spark, place[2])
        return True

    def forget(self, spark: SparkSession, *tokens: str) -> None:
        """Drop the markers of tokens that are not written again."""
        place = self.place(spark)
        if place is not None:
            forget(spark, place[0], tokens)

    def fit(self, df: DataFrame) -> DataFrame:
        """``df`` with exactly the table's columns, in its order and types."""
        schema = self.schema(df.sparkSession)
        given = {c.lower(): c for c in df.columns}
        unknown = set(given) - {n.lower() for n in schema.names}
        if unknown:
            raise ValueError(f"{self.table} has no column {', '.join(sorted(unknown))}")
        return df.select(
            [
                (quoted(given[f.name.lower()]) if f.name.lower() in given else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in schema
            ]
        )

    def run(self, spark: SparkSession, statements: Sequence[str], run_date: date | None) -> None:
        for statement in statements:
            markers = statement.count("?")
            if markers and run_date is None:
                raise ValueError(f"statement needs a run date: {statement}")
            spark.sql(statement, args=[run_date] * markers or None)


Table = JdbcTable | CatalogTable


def jdbc_options(params: Mapping[str, Any]) -> dict[str, str]:
    """``driver`` and ``jdbc-options`` (``name=value;…``) of a parameter set."""
    given = (item.split("=", 1) for item in (params.get("jdbc-options") or "").split(";") if item)
    options = {name: value for name, value in given}
    if params.get("driver"):
        options["driver"] = params["driver"]
    return options


def split_script(script: str) -> list[str]:
    """Statements of a ``;``-separated script, empty ones left out."""
    return [s for s in script.split(";") if s.strip()]
