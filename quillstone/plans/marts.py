"""Facts, dimensions, reports and controls: each a pure function to a lazy DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillstone.operators import relational as R
from quillstone.sources import tables as S

DEC = S.DECIMAL
LAYERS = ("settled", "pending", "encumbrance")
GRAIN = ["journal_id", "account_id", "currency", "layer"]


def fct_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A debit of the customer and a credit of the supplier for each order line.

    Lines of an order are numbered over all their columns, as (order, line) is not
    unique; the numbering is partitioned by order, like the join, so it adds no shuffle.
    """
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    li = S.lines(spark, sf_dir).withColumn("n", F.row_number().over(w).cast("bigint"))
    units = S.money("l_extendedprice")
    base = li.select(
        S.padded("T", "l_orderkey", 12).alias("transaction_id"), "n", S.padded("J", "n_regionkey", 4).alias("journal_id"),
        F.col("l_returnflag").alias("currency"), F.when(F.col("l_linestatus") == "F", "settled").otherwise("pending").alias("layer"), units.alias("units"),
        F.to_date("o_orderdate").alias("effective_date"), F.col("l_shipdate").alias("recorded_at"),
        F.explode(F.array(F.struct(F.lit("debit").alias("direction"), S.padded("C", "o_custkey", 10).alias("account_id"), F.lit(0).alias("leg")), F.struct(F.lit("credit").alias("direction"), S.padded("S", "l_suppkey", 10).alias("account_id"), F.lit(1).alias("leg")))).alias("e"),
    )
    zero = F.lit(0).cast(DEC)
    return base.select(
        F.concat(F.lit("E"), F.substring("transaction_id", 2, 12), F.lpad((2 * F.col("n") + F.col("e.leg")).cast("string"), 6, "0")).alias("entry_id"),
        "transaction_id", "journal_id", "e.account_id", "currency", "layer", "e.direction", "units",
        F.when(F.col("e.direction") == "debit", F.col("units")).otherwise(zero).alias("debit_units"), F.when(F.col("e.direction") == "credit", F.col("units")).otherwise(zero).alias("credit_units"),
        (2 * F.col("n") + F.col("e.leg")).alias("entry_sequence"), "effective_date", "recorded_at",
    )


def balances(entries: DataFrame) -> DataFrame:
    """Sums by grain, with the latest entry; partial sums are made before the one shuffle."""
    last = F.max(F.struct("recorded_at", "entry_sequence", "entry_id"))["entry_id"]
    return entries.groupBy(*GRAIN).agg(F.sum("debit_units").cast(DEC).alias("dr_balance"), F.sum("credit_units").cast(DEC).alias("cr_balance"), F.count(F.lit(1)).alias("entry_count"), last.alias("latest_entry_id"), F.min("recorded_at").alias("first_entry_at"), F.max("recorded_at").alias("last_entry_at"))


def fct_account_balances(spark: SparkSession, sf_dir: str, entries: DataFrame | None = None) -> DataFrame:
    b = balances(entries if entries is not None else fct_entries(spark, sf_dir))
    normal = S.accounts(spark, sf_dir).select("account_id", "normal_balance_type")
    out = b.join(normal, "account_id", "left").withColumn("balance", R.signed_balance("dr_balance", "cr_balance", "normal_balance_type"))
    return out.select(*GRAIN, "dr_balance", "cr_balance", "balance", "normal_balance_type", "entry_count", "latest_entry_id", "first_entry_at", "last_entry_at")


def trial_balance(spark: SparkSession, sf_dir: str, journal: str | None = None, as_of=None) -> DataFrame:
    """Totals by journal, currency and layer; of entries recorded by ``as_of`` where it is given."""
    entries = _until(fct_entries(spark, sf_dir), as_of)
    if journal is not None:
        entries = entries.where(F.col("journal_id") == journal)
    b = balances(entries)
    total = b.groupBy("journal_id", "currency", "layer").agg(F.count_distinct("account_id").alias("account_count"), F.sum("entry_count").alias("entry_count"), F.sum("dr_balance").cast(DEC).alias("total_debits"), F.sum("cr_balance").cast(DEC).alias("total_credits"), F.max("last_entry_at").alias("as_of"))
    total = total.withColumn("difference", (F.col("total_debits") - F.col("total_credits")).cast(DEC))
    out = total.join(S.journals(spark, sf_dir), "journal_id", "left")
    return out.select("journal_id", "journal_name", "journal_code", "currency", "layer", "account_count", "entry_count", "total_debits", "total_credits", "difference", (F.col("difference") == 0).alias("is_balanced"), "as_of")


def order_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legs of the entries with the order's own key in place of text ids, and no more columns than transactions need."""
    li = S.lines(spark, sf_dir)
    cents = F.col("l_extendedprice").cast("decimal(18,2)")
    legs = F.array(F.struct(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("account_id"), cents.alias("debit_units"), F.lit(0).cast("decimal(18,2)").alias("credit_units")), F.struct(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("account_id"), F.lit(0).cast("decimal(18,2)").alias("debit_units"), cents.alias("credit_units")))
    return li.select("l_orderkey", F.col("n_regionkey").alias("journal"), F.col("l_returnflag").alias("currency"), F.col("l_linestatus").alias("layer"), F.explode(legs).alias("e")).select("l_orderkey", "journal", "currency", "layer", "e.*")


def transactions(legs: DataFrame, key: str) -> DataFrame:
    """Counts by transaction, and whether each of its currencies balances.

    Sums are first made by transaction, currency, layer and account, which also makes
    the accounts distinct; all that follows has the transaction's partitioning.
    """
    each = legs.groupBy(key, "currency", "layer", "account_id").agg(F.sum("debit_units").alias("d"), F.sum("credit_units").alias("c"), F.count(F.lit(1)).alias("n"), F.max("journal").alias("journal"))
    # an account counts where it comes first
    nth = F.row_number().over(Window.partitionBy(key, "account_id").orderBy("currency", "layer"))
    each = each.withColumn("accounts", F.when((nth == 1) & F.col("account_id").isNotNull(), 1).otherwise(0))
    by = each.groupBy(key, "currency").agg(F.sum("d").alias("d"), F.sum("c").alias("c"), F.sum("n").alias("n"), F.max("journal").alias("journal"), F.sum("accounts").alias("accounts"), F.collect_set("layer").alias("layers"))
    return by.groupBy(key).agg(F.max("journal").alias("journal"), F.sum("n").alias("entry_count"), F.count("currency").alias("currency_count"), F.size(F.array_distinct(F.flatten(F.collect_list("layers")))).alias("layer_count"), F.sum("accounts").alias("account_count"), F.bool_and(F.col("d") == F.col("c")).alias("is_balanced"))


def fct_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions(order_legs(spark, sf_dir), "l_orderkey")
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("effective_date"), F.col("o_orderpriority").alias("description"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return o.join(t, "l_orderkey", "left").select(S.padded("T", "l_orderkey", 12).alias("transaction_id"), S.padded("J", "journal", 4).alias("journal_id"), "effective_date", "description", zero("entry_count"), zero("currency_count"), zero("layer_count"), zero("account_count"), "is_balanced")


KEY = GRAIN[:3]


def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of the ledger's own balances: a version for each entry, with a column for each layer.

    An account may have any share of the entries, so its running totals are made within
    years and carried over from year to year.
    """
    e = fct_entries(spark, sf_dir)
    amounts = {f"{x}_{s}": F.when(F.col("layer") == x, F.col(c)).otherwise(F.lit(0).cast(DEC)) for x in LAYERS[:2] for s, c in (("dr", "debit_units"), ("cr", "credit_units"))}
    rows = running(e.select(*KEY, "recorded_at", "entry_sequence", "entry_id", *(c.alias(n) for n, c in amounts.items())), KEY, list(amounts), "version")
    return rows.select(*KEY, "version", "recorded_at", "entry_id", *amounts)


def running(rows: DataFrame, keys: list[str], amounts: list[str], position: str) -> DataFrame:
    """``rows`` with their position in their key and running totals in place of ``amounts``, in the order of recording.

    Totals run within (key, year); what the years before add up to is joined on, so no
    task holds more of a key than a year of it. ``_total`` is the number of the key's rows.
    """
    rows = rows.withColumn("_year", F.year("recorded_at"))
    by_year = rows.groupBy(*keys, "_year").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(a).alias(f"_{a}") for a in amounts))
    past = Window.partitionBy(*keys).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(DEC)
    by_year = by_year.select(*keys, "_year", F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"), *(F.coalesce(F.sum(f"_{a}").over(past), zero).cast(DEC).alias(f"_{a}") for a in amounts))
    w = Window.partitionBy(*keys, "_year").orderBy("recorded_at", "entry_sequence", "entry_id")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(by_year, [*keys, "_year"])
    joined = joined.withColumns({position: (F.row_number().over(w) + F.col("_before")).cast("bigint"), **{a: (F.sum(a).over(run) + F.col(f"_{a}")).cast(DEC) for a in amounts}})
    return joined.drop("_year", "_before", *(f"_{a}" for a in amounts))


def persisted_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's own balances as they stand: a row for each account and currency, its layers made rows.

    The tables have no such projection, so it is summed up here, by account and currency
    with a column for each layer. Controls take any other in its place.
    """
    e = fct_entries(spark, sf_dir)
    zero = F.lit(0).cast(DEC)
    cols = [F.sum(F.when(F.col("layer") == x, F.col(c)).otherwise(zero)).cast(DEC).alias(f"{x}_{s}") for x in LAYERS[:2] for s, c in (("dr", "debit_units"), ("cr", "credit_units"))]
    return R.unpivot_layers(e.groupBy(*KEY).agg(*cols), KEY, LAYERS[:2])


def balances_as_of(spark: SparkSession, sf_dir: str, as_of) -> DataFrame:
    """The ledger's own balances at a time: of each account's history the latest version recorded by then, its layers made rows."""
    last = R.as_of(projection(spark, sf_dir), KEY, "version", "recorded_at", F.lit(as_of).cast("timestamp_ntz"))
    return R.unpivot_layers(last, KEY, LAYERS[:2])


def _kept(df: DataFrame) -> DataFrame:
    """A level of the closure, computed once: a checkpoint, or memory where no checkpoint folder is set."""
    return df.checkpoint() if df.sparkSession.conf.get("spark.checkpoint.dir", None) else df.persist()


def closure(edges: DataFrame) -> DataFrame:
    """(account_set_id, member_id, member_kind, depth, path, member_since) over every path; ids may have any width.

    Only sets have members, so levels are joins of the sets' own edges, and accounts are
    joined once, to all paths between sets. The guard is membership of an array, so a
    cycle ends and one id may contain another; a path can't be longer than there are
    sets. ``member_since`` is the latest date along the path, null where edges have none.
    """
    since = F.col("member_since") if "member_since" in edges.columns else F.lit(None).cast("timestamp_ntz")
    step = edges.select("account_set_id", "member_id", "member_kind", since.alias("member_since"))
    sets = _kept(step.where("member_kind = 'account_set'").select(F.col("account_set_id").alias("_parent"), F.col("member_id").alias("_child"), F.col("member_since").alias("_since")))
    front = sets.select(F.col("_parent").alias("account_set_id"), F.col("_child").alias("at"), F.lit(1).cast("bigint").alias("depth"), F.array("_parent", "_child").alias("steps"), F.col("_since").alias("since"))
    levels = [front]
    while True:
        front = front.join(sets, F.col("at") == F.col("_parent")).where(~F.array_contains("steps", F.col("_child")))
        front = _kept(front.select("account_set_id", F.col("_child").alias("at"), (F.col("depth") + 1).alias("depth"), F.concat("steps", F.array("_child")).alias("steps"), F.greatest("since", "_since").alias("since")))
        if front.isEmpty():
            break
        levels.append(front)
    between = reduce(DataFrame.unionByName, levels)
    leaves = step.where("member_kind <> 'account_set'")
    own = leaves.select("account_set_id", "member_id", "member_kind", F.lit(1).cast("bigint").alias("depth"), F.array("account_set_id", "member_id").alias("steps"), "member_since")
    below = between.join(leaves.withColumnRenamed("account_set_id", "at"), "at").select("account_set_id", "member_id", "member_kind", F.col("depth") + 1, F.concat("steps", F.array("member_id")), F.greatest("since", "member_since")).toDF(*own.columns)
    among = between.select("account_set_id", F.col("at").alias("member_id"), F.lit("account_set").alias("member_kind"), "depth", "steps", F.col("since").alias("member_since"))
    out = own.unionByName(below).unionByName(among)
    return out.select("account_set_id", "member_id", "member_kind", "depth", F.array_join("steps", "/").alias("path"), "member_since")


def dim_account_set_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closure(S.edges(spark, sf_dir))


def dim_account_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each set's place in the hierarchy."""
    members = dim_account_set_members(spark, sf_dir)
    sets = S.account_sets(spark, sf_dir)
    down = members.groupBy("account_set_id").agg(
        F.count_distinct(F.when((F.col("depth") == 1) & (F.col("member_kind") == "account"), F.col("member_id"))).alias("direct_account_count"),
        F.count_distinct(F.when((F.col("depth") == 1) & (F.col("member_kind") == "account_set"), F.col("member_id"))).alias("direct_set_count"),
        F.count_distinct(F.when(F.col("member_kind") == "account", F.col("member_id"))).alias("descendant_account_count"),
        F.max("depth").alias("subtree_depth"),
    )
    up = members.where("member_kind = 'account_set'").groupBy(F.col("member_id").alias("account_set_id")).agg(F.max("depth").alias("depth_from_root"), F.count_if(F.col("depth") == 1).alias("direct_parent_count"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return sets.join(down, "account_set_id", "left").join(up, "account_set_id", "left").select("account_set_id", "journal_id", "name", n("depth_from_root"), F.col("depth_from_root").isNull().alias("is_root"), n("direct_parent_count"), n("direct_account_count"), n("direct_set_count"), n("descendant_account_count"), n("subtree_depth"))


def set_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(journal_id, account_set_id, account_id): the accounts below each set, once however many paths lead to them."""
    below = dim_account_set_members(spark, sf_dir).where("member_kind = 'account'").select("account_set_id", F.col("member_id").alias("account_id")).distinct()
    return below.join(S.account_sets(spark, sf_dir).select("account_set_id", "journal_id"), "account_set_id")


def set_rollup(leaf: DataFrame, pairs: DataFrame) -> DataFrame:
    """Balances of sets from their accounts' in the set's journal."""
    return leaf.join(pairs, ["account_id", "journal_id"]).groupBy("journal_id", "account_set_id", "currency", "layer").agg(F.sum("dr_balance").cast(DEC).alias("dr_balance"), F.sum("cr_balance").cast(DEC).alias("cr_balance"))


def leaf_reconcile(spark: SparkSession, sf_dir: str, persisted: DataFrame | None = None, as_of=None) -> DataFrame:
    """Balances from entries against the ledger's own, for accounts that are no sets; ``persisted`` has the latter (GRAIN, dr_balance, cr_balance).

    With ``as_of`` entries are those recorded by then, and the ledger's own balances the
    versions that were current, unless they are given.
    """
    leaves = S.accounts(spark, sf_dir).where("not is_account_set").select("account_id")
    mine = balances(_until(fct_entries(spark, sf_dir), as_of))
    theirs = persisted if persisted is not None else persisted_balances(spark, sf_dir) if as_of is None else balances_as_of(spark, sf_dir, as_of)
    return R.reconcile(theirs.join(leaves, "account_id", "left_semi"), mine.join(leaves, "account_id", "left_semi"), GRAIN)


def _until(entries: DataFrame, as_of) -> DataFrame:
    return entries if as_of is None else entries.where(F.col("recorded_at") <= F.lit(as_of).cast("timestamp_ntz"))


def set_reconcile(spark: SparkSession, sf_dir: str, persisted: DataFrame | None = None, as_of=None) -> DataFrame:
    """Balances of sets from entries against those from the ledger's own; ``persisted`` has the ledger's leaf balances.

    Both sides are tagged, and roll up together through one set of pairs in one
    aggregation; a side without rows for a set's grain stays null. The membership is
    always the current one.
    """
    mine = balances(_until(fct_entries(spark, sf_dir), as_of)).select(*GRAIN, "dr_balance", "cr_balance")
    theirs = persisted if persisted is not None else persisted_balances(spark, sf_dir) if as_of is None else balances_as_of(spark, sf_dir, as_of)
    both = theirs.select(*GRAIN, "dr_balance", "cr_balance", F.lit(True).alias("own")).unionByName(mine.withColumn("own", F.lit(False)))
    side = lambda own, c: F.sum(F.when(F.col("own") == own, F.col(c))).cast(DEC)
    grain = ["journal_id", "account_set_id", "currency", "layer"]
    rolled = both.join(set_pairs(spark, sf_dir), ["account_id", "journal_id"]).groupBy(*grain).agg(side(True, "dr_balance").alias("ledger_dr_balance"), side(True, "cr_balance").alias("ledger_cr_balance"), side(False, "dr_balance").alias("warehouse_dr_balance"), side(False, "cr_balance").alias("warehouse_cr_balance"))
    return rolled.withColumn("status", R.status(F.col("ledger_dr_balance").isNotNull(), F.col("warehouse_dr_balance").isNotNull()))


def unequal(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose debits and credits differ."""
    out = entries.groupBy(*keys).agg(F.sum("debit_units").cast(DEC).alias("debits"), F.sum("credit_units").cast(DEC).alias("credits"))
    return out.where("debits <> credits").withColumn("difference", (F.col("debits") - F.col("credits")).cast(DEC))


def running_chain(spark: SparkSession, sf_dir: str, last: int | None = None, where=None) -> DataFrame:
    """Running balances along each account's entries, in one layer and currency; the last ``last`` of each if given, of the grains that ``where`` selects."""
    e = fct_entries(spark, sf_dir)
    if where is not None:
        e = e.where(where)
    e = e.select(*GRAIN, "recorded_at", "entry_sequence", "entry_id", F.col("debit_units").alias("running_dr"), F.col("credit_units").alias("running_cr"))
    e = running(e, GRAIN, ["running_dr", "running_cr"], "position")
    if last is not None:
        e = e.where(F.col("position") > F.col("_total") - last)
    return e.withColumn("running_balance", (F.col("running_dr") - F.col("running_cr")).cast(DEC)).select(*GRAIN, "entry_id", "position", "running_dr", "running_cr", "running_balance")
