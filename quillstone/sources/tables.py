"""The ledger's streams and tables over the driver's Parquet tables, and the other sources.

Integer keys become fixed-width text, so that ids sort and compare like the ledger's.
Every function returns a lazy DataFrame; filters and columns reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL = "decimal(38,18)"
#: CSV options under which an unquoted empty field is null and a quoted one an empty string.
CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "nullValue": "\x01"}

EVENT = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("sequence", T.LongType(), False), T.StructField("event_type", T.StringType(), False), T.StructField("event", T.StringType()), T.StructField("context", T.StringType()), T.StructField("recorded_at", T.TimestampNTZType())])


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.options(**CSV).schema(schema).csv(path)


def optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table if its folder exists, else no rows of the same schema."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def jdbc(spark: SparkSession, url: str, table: str, page: int = 5000, init: str | None = None, **options) -> DataFrame:
    """A table of a database, read through a cursor of ``page`` rows; ``init`` runs first on each connection."""
    if init:
        options["sessionInitStatement"] = init
    return landed(spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=page, **options).load())


class Snapshot:
    """All tables of a PostgreSQL database as of one moment.

    A transaction that is held open exports its snapshot, and every connection of every
    read takes it on, so tables that are read at different times, in parallel and after
    a lost executor, agree. ``close`` ends it.
    """

    def __init__(self, spark: SparkSession, url: str):
        self.spark, self.url = spark, url
        self._held = spark._jvm.java.sql.DriverManager.getConnection(url)
        self._held.setAutoCommit(False)
        ask = self._held.createStatement()
        ask.execute("set transaction isolation level repeatable read read only")
        got = ask.executeQuery("select pg_export_snapshot()")
        got.next()
        self.name = got.getString(1)

    def table(self, name: str, page: int = 5000, **options) -> DataFrame:
        init = f"set transaction isolation level repeatable read read only; set transaction snapshot '{self.name}'"
        return jdbc(self.spark, self.url, name, page, init, **options)

    def close(self) -> None:
        self._held.close()


def landed(df: DataFrame) -> DataFrame:
    """Every column of a source as found, in the type that it lands in.

    Integers become bigint, decimals exact, times naive UTC; a column without any value
    is text. A type outside these families is an error, never a silent cast.
    """
    out = []
    for f in df.schema:
        kind, c = f.dataType, F.col(f"`{f.name}`")
        if isinstance(kind, T.TimestampType):
            c = F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")
        elif isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            c = c.cast(DECIMAL)
        elif isinstance(kind, T.NullType | T.VarcharType | T.CharType):
            c = c.cast("string")
        elif not isinstance(kind, T.StringType | T.LongType | T.BooleanType | T.DateType | T.TimestampNTZType):
            raise ValueError(f"no mapping for column {f.name!r} of type {kind.simpleString()}")
        out.append(c.alias(f.name))
    return df.select(*out)


class Registry:
    """Declared tables of a folder by name; one that isn't declared is an error, one that is optional may be absent."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...], optional: dict[str, T.StructType] | None = None):
        self.spark, self.folder, self.names, self.optional = spark, folder, names, optional or {}

    def table(self, name: str) -> DataFrame:
        if name in self.optional:
            return optional(self.spark, f"{self.folder}/{name}.parquet", self.optional[name])
        if name not in self.names:
            raise KeyError(f"no table {name!r} is declared; there are {', '.join(sorted({*self.names, *self.optional}))}")
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def columns(self, name: str) -> dict[str, str]:
        """The columns that the table has, with their types."""
        return {f.name: f.dataType.simpleString() for f in self.table(name).schema}


#: Column types of a source database by family.
FAMILIES = {"uuid": "string", "json": "string", "jsonb": "string", "text": "string", "character varying": "string", "timestamp with time zone": "timestamp", "timestamp without time zone": "timestamp_ntz", "date": "date", "integer": "bigint", "bigint": "bigint", "smallint": "bigint", "boolean": "boolean", "numeric": DECIMAL, "USER-DEFINED": "string"}


def column_type(source_type: str) -> str:
    """The Spark type of a source column; an unknown type is an error, never a silent cast."""
    try:
        return FAMILIES[source_type]
    except KeyError:
        raise ValueError(f"no mapping for source type {source_type!r}") from None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def padded(prefix: str, key: str | Column, width: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def money(column: str) -> Column:
    """Doubles go through two decimals, the same in either engine."""
    return F.col(column).cast("decimal(18,2)").cast(DECIMAL)


def journals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(padded("J", "r_regionkey", 4).alias("journal_id"), F.col("r_name").alias("journal_name"), F.upper("r_name").alias("journal_code"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(padded("C", "c_custkey", 10).alias("account_id"), F.col("c_name").alias("name"), F.lit("debit").alias("normal_balance_type"), F.lit(False).alias("is_account_set"))
    s = table(spark, sf_dir, "supplier").select(padded("S", "s_suppkey", 10).alias("account_id"), F.col("s_name").alias("name"), F.lit("credit").alias("normal_balance_type"), F.lit(False).alias("is_account_set"))
    return c.unionByName(s)


def account_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(padded("N", "n_nationkey", 10).alias("account_set_id"), F.col("n_name").alias("name"), F.lit("debit").alias("normal_balance_type"), padded("J", "n_regionkey", 4).alias("journal_id"))
    r = table(spark, sf_dir, "region").select(padded("R", "r_regionkey", 10).alias("account_set_id"), F.col("r_name").alias("name"), F.lit("debit").alias("normal_balance_type"), padded("J", "r_regionkey", 4).alias("journal_id"))
    return n.unionByName(r)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(account_set_id, member_id, member_kind, member_since): nations hold accounts, regions nations, a root regions; a segment holds customers as well.

    The tables have no dates of membership, so one is made from the member's key.
    """
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    since = lambda key: (F.lit("1992-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col(key) % 1000).cast("int"))).alias("member_since")
    pair = lambda df, parent, child, kind, key: df.select(parent.alias("account_set_id"), child.alias("member_id"), F.lit(kind).alias("member_kind"), since(key))
    segment = F.concat(F.lit("G"), F.lpad(F.conv(F.substring(F.md5("c_mktsegment"), 1, 8), 16, 10), 10, "0"))
    out = pair(c, padded("N", "c_nationkey", 10), padded("C", "c_custkey", 10), "account", "c_custkey")
    for more in (
        pair(s, padded("N", "s_nationkey", 10), padded("S", "s_suppkey", 10), "account", "s_suppkey"),
        pair(c, segment, padded("C", "c_custkey", 10), "account", "c_custkey"),
        pair(table(spark, sf_dir, "nation"), padded("R", "n_regionkey", 10), padded("N", "n_nationkey", 10), "account_set", "n_nationkey"),
        pair(table(spark, sf_dir, "region"), F.lit("T0000000000"), padded("R", "r_regionkey", 10), "account_set", "r_regionkey"),
    ):
        out = out.unionByName(more)
    return out


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's region, null where the customer is unknown."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(n, "c_nationkey", "left").drop("c_nationkey")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate").join(c, "o_custkey", "left")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the account's journal; the columns that entries need, no others.

    Customers meet the orders first, so lines are shuffled once, by order, and stay in
    that partitioning. A line without its order stays, with nulls.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity", "l_shipdate")
    return li.join(orders(spark, sf_dir), "l_orderkey", "left")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream: id, sequence from 1 for each id, event_type, event, context, recorded_at, and the outbox sequence."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.select(padded("U", "user_id", 10).alias("id"), F.row_number().over(w).cast("bigint").alias("sequence"), "event_type", F.col("props").alias("event"), F.lit(None).cast("string").alias("context"), F.col("ts").alias("recorded_at"), (F.col("event_id") + 1).alias("outbox_sequence"), "value")
