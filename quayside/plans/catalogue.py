"""Query catalogue: every operator over the shared test tables, with its SQL twin.

The tables hold clean typed data, so raw encodings and dirty values are made
from whole columns by expression.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shift import shift_date
from ..operators.align import align, with_constants
from ..operators.convert import coerce_to_target, convert
from ..operators.profile import as_text, suggest_rules
from ..operators.rejects import FAILED, split_rejects
from ..session import compiled_session, shared_dir
from ..sinks.bulk_text import split_bulk, write_bulk_text
from ..sinks.once import Folder
from ..sources.files import footer_counts, scan_parquet, select_files, source_stats
from ..spec import LoadSpec
from ..streaming.ingest import ingest_files, ingest_table, stream_parquet
from ..streaming.ledger import Ledger, parse_text_ledger, pending_files
from ..tables import CatalogTable, slice_predicates
from .load import copy_table, run, transform

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RUN_AT = datetime(2024, 1, 15, 12, 30, 0)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
MONEY = T.DecimalType(15, 2)


def query(sql: str) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        QUERIES[make.__name__] = make
        ORACLE[make.__name__] = sql
        return make

    return register


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = scan_parquet(spark, f"{sf}/{name}.parquet")
    return df.selectExpr(*columns) if columns else df


# -- projections --------------------------------------------------------------

ORDERS_TARGET = T.StructType(
    [
        T.StructField("O_OrderDate", T.DateType()),
        T.StructField("O_TOTALPRICE", MONEY),
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("O_OrderStatus", T.StringType()),
        T.StructField("no_such_source", T.StringType()),
    ]
)


@query(
    """SELECT o_orderkey, o_orderstatus AS "O_OrderStatus",
              CAST(o_orderdate AS date) AS "O_OrderDate",
              CAST(o_totalprice AS decimal(15,2)) AS "O_TOTALPRICE",
              '2024-01-14' AS load_dt, 'orders' AS origin
       FROM orders"""
)
def load_orders(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        spark, sf, "orders",
        "o_orderkey", "o_custkey", "o_orderstatus",
        "cast(o_totalprice as string) o_totalprice",
        "substr(cast(o_orderdate as string), 1, 10) o_orderdate",
    )
    spec = LoadSpec(
        date=RUN_AT,
        map_data_fields="o_orderdate=datum1,o_totalprice=numeric",
        custom_column="load_dt=?date[-1day],origin=orders",
    )
    return transform(raw, spec, ORDERS_TARGET)


CUSTOMER_NAMES = ["C_MKTSEGMENT", "no_such_source", "C_CustKey", "c_name"]
ALIGNED = 'SELECT c_custkey AS "C_CustKey", c_name, c_mktsegment AS "C_MKTSEGMENT" FROM customer'


@query(ALIGNED)
def align_source_order(spark: SparkSession, sf: str) -> DataFrame:
    return align(table(spark, sf, "customer"), CUSTOMER_NAMES)


@query(ALIGNED)
def align_target_order(spark: SparkSession, sf: str) -> DataFrame:
    return align(table(spark, sf, "customer"), CUSTOMER_NAMES, order="target")


@query(
    """SELECT o_orderkey,
              CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL
                   ELSE o_orderpriority END AS priority
       FROM orders"""
)
def null_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        spark, sf, "orders", "o_orderkey",
        """case o_orderpriority when '4-NOT SPECIFIED' then 'NULL'
           when '5-LOW' then 'nuLL' else o_orderpriority end priority""",
    )
    return convert(raw, {})


@query(
    """SELECT o_orderkey,
              strftime(o_orderdate - INTERVAL 1 DAY + INTERVAL 2 MONTH - INTERVAL 3 HOUR
                       + INTERVAL 5 MINUTE, '%Y-%m-%d') AS shifted,
              'x' AS fixed, 'run 2024-01-15' AS run_text,
              '2023-12-15' AS month_back, '2024-01-14' AS hour_back
       FROM orders"""
)
def constants_shift(spark: SparkSession, sf: str) -> DataFrame:
    shifted = shift_date(F.col("o_orderdate"), "[-1day][+2month][-3hour][+5minute]")
    rows = table(spark, sf, "orders").select("o_orderkey", shifted.alias("shifted"))
    return with_constants(
        rows,
        "fixed=x,run_text=run ?date,month_back=?date[-1month],hour_back=?date[-1hour]",
        RUN_AT.date(),
    )


# -- conversion rules ---------------------------------------------------------


def rule_query(
    rule: str, source: str, key: str, raw: str, expected: str, show: str = "value"
) -> None:
    """Register ``rule`` over the expression ``raw``; ``expected`` is the DuckDB twin."""

    def make(spark: SparkSession, sf: str) -> DataFrame:
        df = table(spark, sf, source, *key.split(", "), f"{raw} value")
        target = T.StructType([T.StructField("value", MONEY)])
        return convert(df, {"value": rule}, target).withColumn("value", F.expr(show))

    name = f"rule_{rule}" if rule != "date0" else "rule_identity"
    QUERIES[name] = make
    ORACLE[name] = f"SELECT {key}, {expected} AS value FROM {source}"


DAY = "substr(cast(o_orderdate as string), 1, 10)"
SECOND = "substr(cast(ts as string), 1, 19)"
DAYS = "cast(unix_date(cast(o_orderdate as date)) as string)"
MILLIS = "cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) as string)"
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
DUCK_SECOND = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
DUCK_DAYS = "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS date)) AS varchar)"

rule_query(
    "date1", "orders", "o_orderkey",
    f"""case when o_orderstatus = 'P' then substr({DAY}, 1, 7)
        else concat(substr({DAY}, 6, 2), '/', substr({DAY}, 9, 2), '/', substr({DAY}, 1, 4)) end""",
    "CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m') "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END",
)
rule_query(
    "date2", "events", "event_id",
    f"case event_type when 'error' then 'e' else concat({SECOND}, '.0') end",
    f"CASE event_type WHEN 'error' THEN 'e' "
    f"ELSE 'to_date(''' || {DUCK_SECOND} || ''',''yyyy-mm-dd hh24:mi:ss'')' END",
)
rule_query(
    "date3", "events", "event_id",
    f"case event_type when 'error' then substr({SECOND}, 1, 10) else concat({SECOND}, '.250') end",
    f"CASE event_type WHEN 'error' THEN strftime(ts, '%Y-%m-%d') ELSE {DUCK_SECOND} END",
)
rule_query("date4", "events", "event_id", "ts", DUCK_SECOND)
rule_query(
    "date5", "orders", "o_orderkey",
    f"case o_orderstatus when 'P' then concat('d', {DAYS}) when 'F' then concat({DAYS}, '00000') "
    f"else {DAYS} end",
    f"CASE o_orderstatus WHEN 'P' THEN 'd' || {DUCK_DAYS} WHEN 'F' THEN {DUCK_DAYS} || '00000' "
    "ELSE strftime(o_orderdate, '%Y-%m-%d') END",
)
rule_query(
    "date6", "events", "event_id",
    f"case event_type when 'error' then substr({MILLIS}, 1, 9) else {MILLIS} end",
    f"CASE event_type WHEN 'error' THEN substr(CAST(epoch_ms(ts) AS varchar), 1, 9) "
    f"ELSE {DUCK_SECOND} END",
)
rule_query(
    "date7", "part", "p_partkey", "concat('''', p_name, '''s', '\\0')", "p_name || 's'"
)
rule_query(
    "date8", "lineitem", LINE,
    "concat(l_returnflag, case l_linestatus when 'F' then 'y' else '' end)",
    "CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_linestatus = 'F' THEN '1' ELSE l_returnflag END",
)
rule_query("date0", "part", "p_partkey", "p_brand", "p_brand")
rule_query(
    "numeric", "part", "p_partkey",
    """case p_type when 'ECONOMY' then concat(p_retailprice, ' EUR')
       when 'SMALL' then concat('  ', p_retailprice, ' ') else cast(p_retailprice as string) end""",
    "CASE p_type WHEN 'ECONOMY' THEN NULL ELSE CAST(p_retailprice AS decimal(15,2)) END",
)
rule_query(
    "timestamp", "events", "event_id",
    f"""case event_type when 'view' then replace({SECOND}, ' ', 'T')
        when 'error' then substr({SECOND}, 1, 10)
        when 'click' then concat('2024-02-30 ', substr({SECOND}, 12))
        when 'signup' then concat(substr({SECOND}, 1, 11), '25', substr({SECOND}, 14), '.7')
        else {SECOND} end""",
    """CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN NULL
       WHEN 'click' THEN TIMESTAMP '2024-03-01 00:00:00'
                         + (date_trunc('second', ts) - date_trunc('day', ts))
       WHEN 'signup' THEN date_trunc('second', ts) - to_hours(hour(ts)) + INTERVAL 25 HOUR
       ELSE date_trunc('second', ts) END""",
)
rule_query(
    "bigint", "orders", "o_orderkey",
    "concat(case o_orderstatus when 'F' then '+' when 'P' then ' ' else '-' end, o_custkey)",
    "CASE o_orderstatus WHEN 'F' THEN o_custkey WHEN 'P' THEN NULL ELSE -o_custkey END",
)
rule_query(
    "datum1", "orders", "o_orderkey",
    """case o_orderstatus when 'P' then concat(year(o_orderdate), '-2-30')
       when 'F' then cast(o_orderdate as string)
       else concat_ws('-', year(o_orderdate), month(o_orderdate), day(o_orderdate)) end""",
    "CASE o_orderstatus WHEN 'P' THEN make_date(year(o_orderdate), 2, 1) + 29 WHEN 'F' THEN NULL "
    "ELSE CAST(o_orderdate AS date) END",
)
rule_query(
    "datum2", "orders", "o_orderkey",
    f"case o_orderstatus when 'P' then concat('d', {DAYS}) else {DAYS} end",
    "CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS date) END",
)
rule_query("datum3", "events", "event_id", "ts", "ts")
rule_query(
    "datum4", "events", "event_id",
    f"case event_type when 'error' then substr({MILLIS}, 1, 9) else {MILLIS} end",
    "CASE event_type WHEN 'error' THEN NULL ELSE date_trunc('second', ts) END",
)
rule_query(
    "binary", "orders", "o_orderkey",
    "concat(case o_orderstatus when 'P' then 'k' when 'F' then '-' else '' end, o_custkey + 1)",
    """CASE o_orderstatus WHEN 'P' THEN NULL
       WHEN 'F' THEN printf('%08x', 4294967296 - o_custkey - 1)
       ELSE printf('%08x', o_custkey + 1) END""",
    show="lower(hex(value))",
)
rule_query(
    "bit", "lineitem", LINE,
    """case l_returnflag when 'A' then 'yes' when 'N' then 'any'
       else cast(cast(l_quantity * 6 as int) as string) end""",
    """CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0
       ELSE CASE WHEN l_quantity * 6 < 128 THEN CAST(l_quantity * 6 AS bigint) END END""",
    show="cast(value as bigint)",
)

VENDOR_TYPES = {
    "as_tinyint": "TinyInt", "as_bit": "BIT", "as_int8": "int8", "as_numeric": "numeric(15,2)",
    "as_varchar": "VARCHAR", "as_fixed": "FixedString(16)", "as_datetime": "DATETIME",
    "as_other": "DATE", "line": "INT8", "part": "INT8", "order": "INT8", "supplier": "INT8",
}


@query(
    """SELECT l_orderkey AS "order", CAST(l_linenumber AS bigint) AS line, l_partkey AS part,
              l_suppkey AS supplier,
              CASE WHEN l_quantity * 6 < 128 THEN CAST(l_quantity * 6 AS bigint) END AS as_tinyint,
              CASE l_returnflag WHEN 'A' THEN NULL ELSE CAST(l_linenumber AS bigint) END AS as_bit,
              CASE l_returnflag WHEN 'A' THEN l_partkey ELSE 0 END AS as_int8,
              CASE l_returnflag WHEN 'A' THEN NULL
                   ELSE CAST(l_extendedprice AS decimal(15,2)) END AS as_numeric,
              l_linestatus AS as_varchar, l_returnflag AS as_fixed,
              CASE l_returnflag WHEN 'A' THEN NULL ELSE l_shipdate END AS as_datetime,
              strftime(l_shipdate, '%Y-%m-%d') AS as_other
       FROM lineitem"""
)
def coerce_target(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        compiled_session(spark), sf, "lineitem",
        "l_orderkey `order`", "l_linenumber line", "l_partkey part", "l_suppkey supplier",
        "cast(cast(l_quantity * 6 as int) as string) as_tinyint",
        "case l_returnflag when 'A' then concat(' ', l_linenumber) else cast(l_linenumber as string) end as_bit",
        """case l_returnflag when 'R' then null when 'A' then concat(' ', l_partkey, ' ')
           else concat(l_partkey, '.0') end as_int8""",
        "case l_returnflag when 'A' then 'n/a' else cast(l_extendedprice as string) end as_numeric",
        "l_linestatus as_varchar",
        "l_returnflag as_fixed",
        """concat(replace(cast(l_shipdate as string), ' ',
           case l_returnflag when 'A' then 'T' else ' ' end), '.0') as_datetime""",
        "substr(cast(l_shipdate as string), 1, 10) as_other",
    )
    return coerce_to_target(raw, VENDOR_TYPES, T.StructType([T.StructField("as_numeric", MONEY)]))


# -- rejects, bulk text, profiling --------------------------------------------

PART_RULES = {"price": "numeric", "size": "bigint", "made": "date1"}


def dirty_part(spark: SparkSession, sf: str) -> DataFrame:
    return table(
        spark, sf, "part", "p_partkey",
        "case p_type when 'ECONOMY' then concat(p_retailprice, ' EUR') else cast(p_retailprice as string) end price",
        "case when p_name like 'red%' then concat(p_size, '.0') when p_name like 'blue%' then null "
        "else cast(p_size as string) end size",
        "case when p_size > 40 then '1/2/24' else '01/02/2024' end made",
    )


@query(
    """WITH judged AS (
         SELECT *, concat_ws(',', CASE WHEN p_type = 'ECONOMY' THEN 'price' END,
                             CASE WHEN p_name LIKE 'red%' THEN 'size' END,
                             CASE WHEN p_size > 40 THEN 'made' END) AS failed
         FROM part)
       SELECT p_partkey, failed,
              CASE WHEN p_type = 'ECONOMY' THEN CAST(p_retailprice AS varchar) || ' EUR'
                   ELSE CAST(p_retailprice AS varchar) END AS price
       FROM judged WHERE failed <> ''"""
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = split_rejects(dirty_part(spark, sf), PART_RULES)
    return bad.select("p_partkey", F.array_join(FAILED, ",").alias("failed"), "price")


@query(
    """SELECT p_partkey, CAST(p_retailprice AS decimal(15,2)) AS price,
              CASE WHEN p_name LIKE 'blue%' THEN NULL ELSE CAST(p_size AS bigint) END AS size,
              '2024-01-02' AS made
       FROM part
       WHERE p_type <> 'ECONOMY' AND p_name NOT LIKE 'red%' AND p_size <= 40"""
)
def accepted(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType([T.StructField("PRICE", MONEY)])
    good, _ = split_rejects(dirty_part(spark, sf), PART_RULES, target)
    return good


@query(
    """SELECT CAST(o_orderkey AS varchar) || chr(9) || o_orderstatus || 's' || chr(9)
              || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END || chr(9)
              || strftime(o_orderdate, '%Y-%m-%d') || chr(9) || CAST(o_totalprice AS varchar)
              || chr(9) || '2024-01-15' || chr(9) AS value
       FROM orders"""
)
def bulk_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        spark, sf, "orders", "o_orderkey",
        "concat(o_orderstatus, '''s') status",
        "case o_orderpriority when '5-LOW' then 'Null' else o_orderpriority end priority",
        f"concat(substr({DAY}, 6, 2), '.', substr({DAY}, 9, 2), '.', substr({DAY}, 1, 4)) day",
        "o_totalprice",
    )
    lines, _ = split_bulk(
        raw, "day=date1,o_totalprice=numeric", "load_dt=?date", RUN_AT.date()
    )
    return lines


@query(
    """SELECT doc_id, n_chars, 'text' AS failed FROM documents
       WHERE regexp_matches(text, '[\\t\\r\\n]')"""
)
def bulk_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = split_bulk(table(spark, sf, "documents"))
    return bad.select("doc_id", "n_chars", F.array_join(FAILED, ",").alias("failed"))


@query(
    """SELECT CAST(event_id AS varchar) AS event_id, CAST(user_id AS varchar) AS user_id,
              CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_type END AS kind,
              strftime(ts, '%Y-%m-%d') AS day
       FROM events"""
)
def text_of_all(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        spark, sf, "events", "event_id", "user_id",
        "case event_type when 'view' then '' when 'click' then 'null' else event_type end kind",
        "cast(ts as date) day",
    )
    return as_text(raw)


@query(
    """WITH texts AS (
         SELECT 'us_date' AS column_name, strftime(o_orderdate, '%m/%d/%Y') AS x FROM orders
         UNION ALL SELECT 'iso_date', strftime(o_orderdate, '%Y/%m/%d') FROM orders
         UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders)
       SELECT column_name,
              CASE WHEN coalesce(bool_or(regexp_full_match(replace(x, '/', ''), '[0-9]+')
                        AND length(split_part(x, '/', 3)) > 3
                        AND TRY_CAST(split_part(x, '/', 1) AS integer) < 13
                        AND TRY_CAST(split_part(x, '/', 2) AS integer) > 12), false)
                   THEN 'date1' ELSE 'date0' END AS rule
       FROM texts GROUP BY column_name"""
)
def suggested_rules(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(
        spark, sf, "orders", "o_orderkey",
        f"concat(substr({DAY}, 6, 2), '/', substr({DAY}, 9, 2), '/', substr({DAY}, 1, 4)) us_date",
        f"replace({DAY}, '-', '/') iso_date",
        "o_orderstatus",
    )
    return suggest_rules(raw)


# -- files, ledger ------------------------------------------------------------


@query(
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, (SELECT count(*) FROM {t}) AS row_count" for t in TABLES
    )
)
def file_stats(spark: SparkSession, sf: str) -> DataFrame:
    counts = footer_counts(spark, [f"{sf}/{t}.parquet" for t in TABLES])
    return counts.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "row_count")


@query("SELECT 'lineitem' AS source, count(*) AS row_count FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders")
def rows_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each file of a scan, added up by source: a scan that reads no column."""
    stats = [source_stats(table(spark, sf, t)).select(F.lit(t).alias("source"), "row_count") for t in ("lineitem", "orders")]
    return reduce(DataFrame.unionAll, stats).groupBy("source").agg(F.sum("row_count").alias("row_count"))


# one file per event: its name carries the clock time, its age is the event's time
DUCK_NAME = """CASE event_type WHEN 'error' THEN event_id || '_' || strftime(ts, '%H%M%S') || '.parquet'
                    ELSE event_id || '_' || strftime(ts, '%H%M%S') || '_' || event_type END"""


def event_files(spark: SparkSession, sf: str) -> DataFrame:
    clock = f"replace(substr({SECOND}, 12), ':', '')"
    files = table(
        spark, sf, "events",
        f"""concat(event_id, '_', {clock},
            case event_type when 'error' then '.parquet' else concat('_', event_type) end) name""",
        "cast(ts as timestamp) modified_at",
        "event_type",
    )
    return files.withColumn("path", F.concat(F.lit("/in/"), "name"))


@query(f"SELECT '/in/' || {DUCK_NAME} AS path FROM events WHERE ts < TIMESTAMP '2024-01-15 12:30:00'")
def select_mtime(spark: SparkSession, sf: str) -> DataFrame:
    return select_files(event_files(spark, sf), 1, RUN_AT).select("path")


@query(
    f"""SELECT '/in/' || {DUCK_NAME} AS path FROM events
        WHERE event_type <> 'error' AND CAST(strftime(ts, '%H%M%S') AS integer) <= 123000
           OR length(CAST(event_id AS varchar)) = 6 AND event_id <= 123000"""
)
def select_token(spark: SparkSession, sf: str) -> DataFrame:
    return select_files(event_files(spark, sf), 3, RUN_AT).select("path")


@query(
    f"""SELECT '/in/' || {DUCK_NAME} AS path FROM events
        WHERE event_type NOT IN ('view', 'click')"""
)
def ledger_pending(spark: SparkSession, sf: str) -> DataFrame:
    files = event_files(spark, sf)
    return pending_files(files, reduce(DataFrame.unionAll, event_entries(files))).select("path")


def event_entries(files: DataFrame) -> list[DataFrame]:
    """Two waves of ledger entries, the later of which changes some of the earlier."""
    started = files.where("event_type <> 'error'").selectExpr(
        "path", "case event_type when 'purchase' then 'complete' else 'started' end status",
        "modified_at completed_at",
    )
    ended = files.where("event_type <> 'error' and event_type <> 'signup'").selectExpr(
        "path", "case event_type when 'purchase' then 'failed' else 'complete' end status",
        "modified_at + interval 1 hour completed_at",
    )
    return [started, ended]


@query(
    f"""SELECT '/in/' || {DUCK_NAME} AS path FROM events
        WHERE event_type NOT IN ('view', 'click')"""
)
def ledger_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """The same files against a ledger whose first wave has become its bucketed history."""
    files, ledger = event_files(spark, sf), Ledger(spark, shared_dir(spark, "ledger"))
    started, ended = event_entries(files)
    ledger.take_over(started)
    ledger.compact()
    ledger.take_over(ended)
    return ledger.pending(files).select("path")


@query(
    """SELECT '/in/' || user_id AS path, arg_max(event_type, event_id) AS status,
              date_trunc('second', arg_max(ts, event_id)) AS completed_at
       FROM events GROUP BY user_id"""
)
def text_ledger(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(
        spark, sf, "events",
        f"concat('/in/', user_id, '\t', event_type, ';', {SECOND}) value",
        "event_id position",
    )
    entries = parse_text_ledger(lines)
    return entries.withColumn("completed_at", F.col("completed_at").cast("timestamp_ntz"))


# -- whole loads --------------------------------------------------------------


def new_table(spark: SparkSession, columns: str) -> CatalogTable:
    name = f"quayside_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{shared_dir(spark, name)}'")
    return CatalogTable(name)


@query(
    """SELECT c_custkey, c_name, CAST(c_acctbal AS decimal(15,2)) AS c_acctbal,
              CAST(NULL AS date) AS loaded
       FROM customer"""
)
def table_copy(spark: SparkSession, sf: str) -> DataFrame:
    source = CatalogTable(f"customer_{uuid.uuid4().hex}")
    table(spark, sf, "customer").createOrReplaceTempView(source.table)
    target = new_table(spark, "c_custkey BIGINT, c_name STRING, c_acctbal DECIMAL(15,2), loaded DATE")
    copy_table(spark, source, target, "C_CUSTKEY,C_NAME,C_ACCTBAL,C_MKTSEGMENT")
    return spark.table(target.table)


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS bigint) AS l_linenumber,
              CAST(l_extendedprice AS decimal(15,2)) AS l_extendedprice,
              CAST(l_shipdate AS date) AS l_shipdate,
              CASE WHEN l_returnflag = 'N' THEN '0' ELSE l_returnflag END AS l_returnflag,
              DATE '2024-01-14' AS load_dt
       FROM lineitem"""
)
def load_run(spark: SparkSession, sf: str) -> DataFrame:
    """The envelope with a ledger, twice: the second run finds nothing to do."""
    target = new_table(
        spark,
        "l_returnflag STRING, l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, "
        "l_linenumber BIGINT, l_extendedprice DECIMAL(15,2), l_shipdate DATE, load_dt DATE",
    )
    base = shared_dir(spark, "load")
    spec = LoadSpec(
        root=sf, source_file_expression="/", file_filter="lineitem", date=RUN_AT,
        with_log=2, ledger_path=f"{base}/ledger", rejects_path=f"{base}/rejects",
        map_data_fields="l_extendedprice=numeric,L_SHIPDATE=datum1,l_returnflag=date8",
        custom_column="load_dt=?date[-1day]",
    )
    for _ in range(2):
        run(spark, spec, target)
    return spark.table(target.table)


@query(
    """SELECT o_orderkey, CAST(o_totalprice AS decimal(15,2)) AS o_totalprice,
              CAST(o_orderdate AS date) AS o_orderdate FROM orders"""
)
def ingest_available(spark: SparkSession, sf: str) -> DataFrame:
    """The same load as a stream, twice: the checkpoint keeps the second from repeating it."""
    base = shared_dir(spark, "ingest")
    schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    for _ in range(2):
        stream = stream_parquet(spark, sf, schema, ["orders"])
        rows = align(stream, ["o_orderkey", "o_totalprice", "o_orderdate"])
        target = T.StructType([T.StructField("o_totalprice", MONEY)])
        loaded = convert(rows, "o_totalprice=numeric,o_orderdate=datum1", target)
        ingest_files(loaded, f"{base}/data", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/data")


# -- order, types and steps that values alone do not show ------------------------


@query(
    """SELECT 'source' AS kind, 'C_CustKey,c_name,C_MKTSEGMENT' AS names, count(*) AS n FROM customer
       UNION ALL SELECT 'target', 'C_MKTSEGMENT,C_CustKey,c_name', count(*) FROM customer"""
)
def column_order(spark: SparkSession, sf: str) -> DataFrame:
    found = []
    for order in ("source", "target"):
        df = align(table(spark, sf, "customer"), CUSTOMER_NAMES, order=order)
        found.append(df.agg(F.count("*").alias("n")).select(F.lit(order).alias("kind"), F.lit(",".join(df.columns)).alias("names"), "n"))
    return reduce(DataFrame.unionAll, found)


FLOAT_TEXT = """case o_orderstatus when 'F' then concat(cast(o_orderkey as string), '.123456789012e-18')
                when 'O' then concat(cast(o_orderkey as string), 'e30') else 'n/a' end"""


@query(
    """SELECT o_orderkey,
              TRY_CAST(CASE o_orderstatus WHEN 'F' THEN o_orderkey || '.123456789012e-18'
                       WHEN 'O' THEN o_orderkey || 'e30' ELSE 'n/a' END AS double) AS x
       FROM orders"""
)
def rule_numeric_double(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders", "o_orderkey", f"{FLOAT_TEXT} x")
    return convert(raw, "x=numeric", T.StructType([T.StructField("X", T.DoubleType())]))


@query(
    """SELECT o_orderkey,
              TRY_CAST(CASE o_orderstatus WHEN 'F' THEN o_orderkey || '.123456789012e-18'
                       WHEN 'O' THEN o_orderkey || 'e30' ELSE 'n/a' END AS double) AS x
       FROM orders"""
)
def coerce_float(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "orders", "o_orderkey", f"{FLOAT_TEXT} x")
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("x", T.DoubleType())])
    return coerce_to_target(raw, {"o_orderkey": "OTHER", "x": "FLOAT8"}, target).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    """SELECT CAST(o_orderkey AS varchar) AS k,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderstatus = 'F' AS bigint) END AS b,
              CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_orderstatus = 'F' AS bigint) END AS i,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderstatus = 'F' AS integer)::decimal(38,10) END AS n
       FROM orders"""
)
def coerce_boolean(spark: SparkSession, sf: str) -> DataFrame:
    flag = "nullif(o_orderstatus, 'P') = 'F'"
    raw = table(spark, sf, "orders", "o_orderkey k", f"{flag} b", f"{flag} i", f"{flag} n")
    return coerce_to_target(raw, {"k": "OTHER", "b": "BIT", "i": "INT8", "n": "NUMERIC"})


@query("SELECT o_orderkey, CAST(o_custkey AS varchar) AS o_custkey FROM orders")
def rule_other(spark: SparkSession, sf: str) -> DataFrame:
    return convert(table(spark, sf, "orders", "o_orderkey", "o_custkey"), "o_custkey=no_such_rule")


@query(
    """SELECT CAST(doc_id AS varchar) AS doc_id,
              nullif(replace(CASE WHEN lower(text) <> 'null' THEN text END, '''', ''), '') AS text
       FROM documents"""
)
def load_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """A bulk-mode load with rejects asked for keeps the rows whose texts hold line breaks."""
    target = new_table(spark, "doc_id STRING, text STRING")
    spec = LoadSpec(
        root=sf, source_file_expression="/documents.parquet", mode_type=5,
        rejects_path=f"{shared_dir(spark, 'bulk')}/rejects",
    )
    run(spark, spec, target)
    return spark.table(target.table)


@query(
    """SELECT w AS wave_files, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment
       FROM customer, (VALUES (1), (100)) AS waves(w)"""
)
def load_merged_waves(spark: SparkSession, sf: str) -> DataFrame:
    """Files of two schemas: the later one's column arrives, however the files are cut into waves."""
    base = shared_dir(spark, "merged")
    customer = table(spark, sf, "customer")
    customer.where("c_custkey % 2 <> 0").select("c_custkey").write.parquet(f"{base}/in")
    customer.where("c_custkey % 2 = 0").select("c_custkey", "c_mktsegment").write.mode("append").parquet(f"{base}/in")
    found = []
    for wave_files in (1, 100):
        target = new_table(spark, "c_custkey BIGINT, c_mktsegment STRING")
        spec = LoadSpec(
            root=base, source_file_expression="/in", with_log=2, ledger_path=f"{base}/ledger-{wave_files}",
            merge_schema=True, wave_files=wave_files,
        )
        run(spark, spec, target)
        found.append(spark.table(target.table).select(F.lit(wave_files).alias("wave_files"), "*"))
    return reduce(DataFrame.unionAll, found)


@query(
    """SELECT 'before' AS step, DATE '2024-01-15' AS d, 0 AS n UNION ALL
       SELECT 'after', DATE '2024-01-15', count(*) FROM nation UNION ALL
       SELECT 'written', DATE '2024-01-15', count(*) FROM nation UNION ALL
       SELECT 'error', DATE '2024-01-15', count(*) FROM nation UNION ALL
       SELECT 'empty', DATE '2024-01-15', 0"""
)
def load_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Scripts around a templated load, its counts, a failing load, and an empty one that runs nothing."""
    base = shared_dir(spark, "steps")
    table(spark, sf, "nation").write.parquet(f"{base}/20240115/12")
    target = new_table(spark, "n_nationkey BIGINT, n_name STRING")
    log = new_table(spark, "step STRING, d DATE, n BIGINT").table
    entry = f"INSERT INTO {log} SELECT '{{}}', ?, count(*) FROM {target.table};"
    spec = LoadSpec(
        root=base, source_file_expression="/@format/@format,[yyyyMMdd,HH]", date=RUN_AT,
        script_before=entry.format("before"), script_after=entry.format("after"),
    )
    report = run(spark, spec, target)
    spark.sql(f"INSERT INTO {log} SELECT 'written', DATE'2024-01-15', {report.rows_written}")

    class Failing(CatalogTable):
        def write(self, df: DataFrame, **_: object) -> None:
            raise RuntimeError("no room")

    failing = LoadSpec(root=base, source_file_expression="/20240115/12", date=RUN_AT, on_error=entry.format("error"))
    try:
        run(spark, failing, Failing(target.table))
    except RuntimeError:
        pass
    table(spark, sf, "nation").where("n_nationkey < 0").write.parquet(f"{base}/empty")
    empty = LoadSpec(root=base, source_file_expression="/empty", date=RUN_AT, script_before=entry.format("never"))
    spark.sql(f"INSERT INTO {log} SELECT 'empty', DATE'2024-01-15', {run(spark, empty, target).rows_read}")
    return spark.table(log)


INT96_CONF = "spark.sql.parquet.outputTimestampType"


@query(
    """SELECT event_id, date_trunc('second', ts) AS at, date_trunc('second', ts) + INTERVAL 12 HOUR AS from_noon,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_text
       FROM events"""
)
def rule_int96(spark: SparkSession, sf: str) -> DataFrame:
    """Times stored as INT96, read back with and without counting from noon."""
    sister = spark.newSession()
    sister.conf.set("spark.sql.session.timeZone", "UTC")
    sister.conf.set(INT96_CONF, "INT96")
    path = shared_dir(spark, "int96")
    second = F.date_trunc("second", "ts").cast("timestamp")  # INT96 holds instants
    scan_parquet(sister, f"{sf}/events.parquet").select("event_id", second.alias("ts")).write.parquet(path)
    raw = scan_parquet(sister, path).selectExpr("event_id", "ts at", "ts from_noon", "ts as_text")
    plain = convert(raw.select("event_id", "at", "as_text"), "at=datum3,as_text=date4")
    noon = convert(raw.select("event_id", "from_noon"), "from_noon=datum3", int96_noon=True)
    return plain.join(noon.hint("merge"), "event_id")


@query(
    """SELECT CAST(n_nationkey AS varchar) || chr(9) || replace(n_name, '''', '') || chr(9) AS value
       FROM nation"""
)
def bulk_file(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of the written bulk file, as they stand between its CRLFs."""
    path = shared_dir(spark, "bulk-file")
    lines, _ = split_bulk(table(spark, sf, "nation", "n_nationkey", "n_name"))
    write_bulk_text(lines, path)
    return spark.read.option("lineSep", "\r\n").text(path)


# -- loads that split, verify, and write once ------------------------------------


def rejected(spark: SparkSession, spec: LoadSpec, *columns: str) -> DataFrame:
    """Rejects of a load: the failing columns and these others, all as text."""
    bad = spark.read.parquet(spec.rejects_path)
    return bad.select(F.array_join(FAILED, ",").alias("failed"), *[F.col(c).cast("string").alias(c) for c in columns])


@query(
    """WITH judged AS (
         SELECT *, concat_ws(',', CASE WHEN p_type = 'ECONOMY' THEN 'price' END,
                             CASE WHEN p_name LIKE 'red%' THEN 'size' END,
                             CASE WHEN p_size > 40 THEN 'made' END) AS failed
         FROM part)
       SELECT failed, CAST(p_partkey AS varchar) AS p_partkey,
              CASE WHEN p_type = 'ECONOMY' THEN CAST(p_retailprice AS varchar) || ' EUR'
                   WHEN failed <> '' THEN CAST(p_retailprice AS varchar)
                   ELSE CAST(CAST(p_retailprice AS decimal(15,2)) AS varchar) END AS price
       FROM judged"""
)
def load_split(spark: SparkSession, sf: str) -> DataFrame:
    """A load that splits good rows from rejects in one pass over its files."""
    base = shared_dir(spark, "split")
    dirty_part(spark, sf).write.parquet(f"{base}/in")
    target = new_table(spark, "p_partkey BIGINT, price DECIMAL(15,2), size BIGINT, made STRING")
    spec = LoadSpec(
        root=base, source_file_expression="/in", with_log=2, ledger_path=f"{base}/ledger", verify_files=True,
        rejects_path=f"{base}/rejects", map_data_fields="price=numeric,size=bigint,made=date1",
    )
    run(spark, spec, target)
    good = spark.table(target.table).selectExpr("'' failed", "cast(p_partkey as string) p_partkey", "cast(price as string) price")
    return good.unionByName(rejected(spark, spec, "p_partkey", "price"))


@query(
    """WITH sent AS (
         SELECT o_orderkey, o_orderstatus, unnest(CASE o_orderstatus WHEN 'P' THEN [1, 2, 3] ELSE [1] END) AS copy FROM orders
         UNION ALL SELECT NULL, 'x', 1 UNION ALL SELECT NULL, 'y', 1
       ), counted AS (
         SELECT o_orderkey, count(*) AS n, CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS known FROM sent
         WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)
       SELECT '' AS failed, CAST(o_orderkey AS varchar) AS k, 1 AS rows FROM counted UNION ALL
       SELECT '', NULL, 2 UNION ALL
       SELECT 'k', CAST(o_orderkey AS varchar), n - 1 + known FROM counted WHERE n - 1 + known > 0"""
)
def load_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A load whose rows may hold keys that the table has, or that come twice: the first row of a key is loaded."""
    base = shared_dir(spark, "keys")
    orders = table(spark, sf, "orders")
    sent = orders.selectExpr("o_orderkey k", "explode(if(o_orderstatus = 'P', array(1, 2, 3), array(1))) copy")
    sent.unionAll(spark.sql("SELECT NULL, 1 UNION ALL SELECT NULL, 1")).write.parquet(f"{base}/in")
    target = new_table(spark, "copy INT, K BIGINT")
    orders.where("o_orderkey % 10 = 0").selectExpr("0 copy", "o_orderkey k").write.insertInto(target.table)
    spec = LoadSpec(
        root=base, source_file_expression="/in", with_log=2, ledger_path=f"{base}/ledger",
        rejects_path=f"{base}/rejects", key_columns="k",
    )
    run(spark, spec, target)
    good = spark.table(target.table).selectExpr("'' failed", "cast(K as string) k")
    bad = rejected(spark, spec, "K").selectExpr("lower(failed) failed", "K k")
    return good.unionAll(bad).groupBy("failed", "k").agg(F.count("*").alias("rows"))


@query(
    """SELECT CASE WHEN length(c_name) > 15 THEN 'name' ELSE '' END AS failed, CAST(c_custkey AS varchar) AS c_custkey,
              CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_name || '        ' END AS name
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || '#' ELSE substr(c_name, 1, 12) END AS c_name FROM customer)
       WHERE length(c_name) > 15
       UNION ALL
       SELECT '', CAST(c_custkey AS varchar), CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_name || '   ' END
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || '#' ELSE substr(c_name, 1, 12) END AS c_name FROM customer)
       WHERE length(c_name) <= 15"""
)
def load_widths(spark: SparkSession, sf: str) -> DataFrame:
    """A load into a column of 15 characters: longer texts are rejects, trailing blanks beyond them are cut off."""
    base = shared_dir(spark, "widths")
    name = "if(c_custkey % 3 = 0, concat(c_name, '#'), substr(c_name, 1, 12))"
    raw = table(spark, sf, "customer", "c_custkey", f"if(c_custkey % 2 = 0, {name}, concat({name}, '        ')) name")
    raw.write.parquet(f"{base}/in")
    target = new_table(spark, "c_custkey BIGINT, name VARCHAR(15)")
    spec = LoadSpec(
        root=base, source_file_expression="/in", with_log=2, ledger_path=f"{base}/ledger", rejects_path=f"{base}/rejects"
    )
    run(spark, spec, target)
    good = spark.table(target.table).selectExpr("'' failed", "cast(c_custkey as string) c_custkey", "name")
    return good.unionByName(rejected(spark, spec, "c_custkey", "name"))


@query("SELECT o_orderkey, o_custkey, CAST(o_totalprice AS decimal(15,2)) AS o_totalprice FROM orders")
def ingest_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """A stream into a table whose last batches are played again, as after a crash before their commit."""
    base, target = shared_dir(spark, "replayed"), new_table(spark, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DECIMAL(15,2)")
    raw = table(spark, sf, "orders")
    for even in (0, 1):
        raw.where(f"o_orderkey % 2 = {even}").write.mode("append").parquet(f"{base}/in")
        for _ in range(2):
            stream = stream_parquet(spark, f"{base}/in", raw.schema)
            rows = align(stream, ["o_orderkey", "o_custkey", "o_totalprice"])
            ingest_table(rows, target, f"{base}/checkpoint")
            Folder(spark, f"{base}/checkpoint/commits").remove(str(even))
    return spark.table(target.table)


@query(
    """SELECT 1 AS run, n_nationkey, n_name FROM nation WHERE n_nationkey < 0 UNION ALL
       SELECT 2, n_nationkey, n_name FROM nation"""
)
def load_due(spark: SparkSession, sf: str) -> DataFrame:
    """Files that arrive before they are due wait beside the stream's checkpoint, and a later run loads them."""
    base, found = shared_dir(spark, "due"), []
    table(spark, sf, "nation").write.parquet(f"{base}/in")
    for number, at in enumerate((datetime(2000, 1, 1), datetime(2999, 1, 1)), 1):
        target = new_table(spark, "n_nationkey BIGINT, n_name STRING")
        spec = LoadSpec(
            root=base, source_file_expression="/in", with_log=1, date=at, ledger_path=f"{base}/ledger", arrivals_path=f"{base}/arrivals"
        )
        run(spark, spec, target)
        found.append(spark.table(target.table).select(F.lit(number).alias("run"), "*"))
    return reduce(DataFrame.unionAll, found)


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS bigint) AS q FROM lineitem")
def read_slices(spark: SparkSession, sf: str) -> DataFrame:
    """A table read in slices of equally many rows of a column whose values crowd: each row in one of them."""
    source = CatalogTable(f"lineitem_{uuid.uuid4().hex}")
    crowded = "cast(if(l_linenumber < 4, 7, if(l_quantity = 7, null, l_quantity)) as bigint) cut"
    table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "cast(l_quantity as bigint) q", crowded).createOrReplaceTempView(source.table)
    slices = slice_predicates("cut", source.slice_starts(spark, "cut", 16))
    return source.read(spark, ["l_orderkey", "l_linenumber", "q"], predicates=slices)
