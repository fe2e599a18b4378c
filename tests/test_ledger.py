"""Ledger operators on toy data: invariants, edge cases and agreement of two ways."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from quillstone.functions import jsonx as J
from quillstone.operators import relational as R
from quillstone.plans import marts as M
from quillstone.sources import tables as S
from quillstone.streaming import ingest as I

SF = "/root/testdata/sf0.001"
D = decimal.Decimal


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_json_values(spark):
    df = spark.createDataFrame([('{"a": 1.500000000000000001, "b": "2.5", "n": null, "t": "2020-01-01T15:29:45+02:00", "o": {"z": 1, "y": 2}, "l": ["x", "y"]}',)], "e string")
    r = df.select(J.json_decimal("e", "a"), J.json_decimal("e", "b"), J.json_string("e", "n"), J.json_string("e", "q"), J.json_timestamp("e", "t"), J.json_object("e", "o"), J.json_string_array("e", "l")).first()
    assert r[0] == D("1.500000000000000001") and r[1] == D("2.5") and r[2] is None and r[3] is None
    assert r[4] == dt.datetime(2020, 1, 1, 13, 29, 45) and r[5] == '{"z":1,"y":2}' and r[6] == ["x", "y"]


def test_latest_first_and_scd2(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5), ("b", None, 7)], "id string, sequence int, recorded_at int")
    assert rows(R.latest_per_key(df, ["id"], ["sequence"])) == [("a", 2, 20), ("b", 1, 5)]
    assert rows(R.first_per_key(df, ["id"], ["sequence"])) == [("a", 1, 10), ("b", 1, 5)]
    v = R.scd2(df.where("sequence is not null"), "id", "sequence", "recorded_at").select("id", "sequence", "valid_to", "is_current")
    assert sorted(map(tuple, v.collect()), key=str) == [("a", 1, 20, False), ("a", 2, None, True), ("b", 1, None, True)]


def test_closure_diamond_cycle_and_prefix_ids(spark):
    e = spark.createDataFrame([("1", "11", "account_set"), ("1", "12", "account_set"), ("11", "x", "account"), ("12", "x", "account"), ("11", "1", "account_set")], "account_set_id string, member_id string, member_kind string")
    got = {(r.account_set_id, r.member_id, r.path) for r in M.closure(e).collect()}
    assert ("1", "x", "1/11/x") in got and ("1", "x", "1/12/x") in got and ("11", "12", "11/1/12") in got
    assert len(got) == 5 + 3 + 1  # five edges, three paths of two steps, one of three; no path meets itself


def test_closure_deep(spark):
    """Deeper than any fixed number of levels is not needed to see that none is built in; dates go along the path."""
    kind = "account_set_id string, member_id string, member_kind string, member_since timestamp_ntz"
    at = [dt.datetime(2020, 1, 1 + (7 * i) % 20) for i in range(19)]
    e = spark.createDataFrame([(f"s{i}", f"s{i + 1}", "account_set", at[i]) for i in range(18)] + [("s18", "x", "account", at[18])], kind)
    got = M.closure(e).collect()
    assert len(got) == 18 * 19 // 2 + 19 and max(r.depth for r in got) == 19
    assert all(r.member_since == max(at[int(r.path[1:].split("/")[0]) :][: r.depth]) for r in got)
    assert M.closure(e.limit(0)).count() == 0


def test_balances_agree_two_ways(spark):
    assert M.leaf_reconcile(spark, SF).where("status not like 'ok%'").count() == 0
    assert M.set_reconcile(spark, SF).where("status not like 'ok%'").count() == 0
    t = M.trial_balance(spark, SF)
    assert t.count() > 0 and t.where("not is_balanced").count() == 0
    assert t.schema["difference"].dataType.simpleString() == "decimal(38,18)"


def test_trial_balance_of_the_end_is_of_now(spark):
    now = rows(M.trial_balance(spark, SF))
    assert rows(M.trial_balance(spark, SF, as_of=dt.datetime(2100, 1, 1))) == now
    assert rows(M.trial_balance(spark, SF, journal="J0001")) == [r for r in now if r[0] == "J0001"]


def test_controls_find_drift_of_a_given_projection(spark):
    own = M.persisted_balances(spark, SF)
    first = own.where("dr_balance > 0").orderBy(*M.GRAIN).first()
    drift = own.withColumn("dr_balance", F.when((F.col("account_id") == first.account_id) & (F.col("currency") == first.currency) & (F.col("layer") == first.layer), F.col("dr_balance") + 1).otherwise(F.col("dr_balance")).cast(M.DEC))
    bad = M.leaf_reconcile(spark, SF, drift).where("status not like 'ok%'").collect()
    assert [(r.account_id, r.status) for r in bad] == [(first.account_id, "amount_mismatch")]
    assert {r.status for r in M.set_reconcile(spark, SF, drift).where("status not like 'ok%'").collect()} == {"amount_mismatch"}


def test_lines_without_an_order_stay(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation", "region", "supplier"):
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        (df.where("o_orderkey > 10") if name == "orders" else df).write.parquet(f"{tmp_path}/{name}.parquet")
    whole, held = M.fct_entries(spark, SF).count(), M.fct_entries(spark, str(tmp_path))
    assert held.count() == whole and held.where("journal_id is null").count() > 0


def test_running_totals_over_years(spark):
    rows = [("a", dt.datetime(2018 + i // 3, 1 + i % 3, 1), i, f"e{i}", D(i + 1)) for i in range(10)] + [("b", dt.datetime(2019, 1, 1), 0, "f", D(5))]
    got = M.running(spark.createDataFrame(rows, "k string, recorded_at timestamp_ntz, entry_sequence int, entry_id string, x decimal(38,18)"), ["k"], ["x"], "at")
    assert sorted((r.k, r.at, r.x, r._total) for r in got.collect()) == [("a", i + 1, D((i + 1) * (i + 2) // 2), 10) for i in range(10)] + [("b", 1, D(5), 1)]


def test_reconcile_statuses(spark):
    kind = "journal_id string, dr_balance decimal(38,18), cr_balance decimal(38,18)"
    a = spark.createDataFrame([("ok", D(1), D(0)), ("zero", D(0), D(0)), ("lost", D(1), D(0)), ("off", D(1), D(0))], kind)
    b = spark.createDataFrame([("ok", D(1), D(0)), ("off", D("1.000000000000000001"), D(0)), ("new", D(0), D(0))], kind)
    got = {r.journal_id: r.status for r in R.reconcile(a, b, ["journal_id"]).collect()}
    assert got == {"ok": "ok", "zero": "ok_untouched_layer", "lost": "missing_in_warehouse", "off": "amount_mismatch", "new": "missing_in_ledger"}


def test_incremental_equals_full(spark, tmp_path):
    ev = S.events(spark, SF).drop("context")
    whole = rows(ev.select("id", "sequence", "event_type"))
    table = I.VersionedTable(spark, f"file://{tmp_path}/t")
    table.merge(ev.where("outbox_sequence <= 400"), ["id", "sequence"])
    new = I.newer_than(ev, I.watermarks(table.read()))
    table.merge(new, ["id", "sequence"])
    table.merge(new, ["id", "sequence"])  # again: nothing changes
    assert rows(table.read().select("id", "sequence", "event_type")) == whole
    assert I.newer_than(ev, I.watermarks(table.read())).count() == 0


def test_foreign_table_is_refused(spark, tmp_path):
    table = I.VersionedTable(spark, f"file://{tmp_path}/t")
    table.replace(spark.range(3))
    with pytest.raises(ValueError):
        table.merge(spark.range(3), ["id"])


def test_of_two_writers_one_fails(spark, tmp_path):
    table, other = (I.VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    table.merge(spark.range(3), ["id"])
    base = other._at()[0]
    table.merge(spark.range(3, 6), ["id"])
    with pytest.raises(I.Conflict):
        other.replace(spark.range(9), base)
    assert rows(table.read().select("id")) == [(i,) for i in range(6)]


def test_reload_of_erased_ids_and_a_bound(spark):
    at = [dt.datetime(2020, 1, d) for d in (1, 2, 3)]
    ev = spark.createDataFrame([(i, s + 1, at[s]) for i in "ab" for s in range(3)], "id string, sequence long, recorded_at timestamp_ntz")
    marks = I.watermarks(ev.where("sequence < 3"))
    again = spark.createDataFrame([("b",)], "id string")
    assert rows(I.newer_than(ev, marks, again=again).select("id", "sequence")) == [("a", 3), ("b", 1), ("b", 2), ("b", 3)]
    assert rows(I.newer_than(ev, marks, again=again, until=at[1]).select("id", "sequence")) == [("b", 1), ("b", 2)]


def test_stream_loads_once(spark, tmp_path):
    src = f"{tmp_path}/src"
    df = spark.range(10).selectExpr("id", "id * 2 as v")
    df.write.parquet(src)
    table = I.VersionedTable(spark, f"file://{tmp_path}/t")
    for _ in range(2):
        I.stream_into(table, spark.readStream.schema(df.schema).parquet(src), ["id"], f"{tmp_path}/cp")
    assert table.read().count() == 10


def test_gaps_cross_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 5, (1 << 20) + 3, (1 << 20) + 4, 3 << 20)], "s long")
    want = [(3, 4), (6, (1 << 20) + 2), ((1 << 20) + 5, (3 << 20) - 1)]
    assert rows(I.gaps(df, "s")) == want
    assert rows(I.gaps(df, "s", above=5)) == want[1:]


def test_watermark():
    none = lambda lo, hi: []
    assert I.resolve_watermark(0, 9, [], lambda: True, none) == I.Advance(9)
    assert I.resolve_watermark(0, 9, [(4, 5)], lambda: False, none) == I.Advance(3, 4)
    assert I.resolve_watermark(0, 9, [(4, 5), (7, 7)], lambda: True, none) == I.Advance(9, None, [(4, 5), (7, 7)])
    assert I.resolve_watermark(0, 9, [(4, 6)], lambda: True, lambda lo, hi: [(6, 6)]) == I.Advance(5, 6, [(4, 5)])


def test_csv_keeps_empty_strings_apart_from_nulls(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,""\n2,\n')
    assert rows(S.csv(spark, str(tmp_path / "a.csv"), "a int, b string").where("b is not null")) == [(1, "")]


def test_the_last_row_of_a_batch_stays(spark, tmp_path):
    src = f"{tmp_path}/src"
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (1, 7, "mid")], "id int, at int, v string")
    df.repartition(3).write.parquet(src)
    table = I.VersionedTable(spark, f"file://{tmp_path}/t")
    I.stream_into(table, spark.readStream.schema(df.schema).parquet(src), ["id"], f"{tmp_path}/cp", ["at"])
    assert [r.v for r in table.read().collect()] == ["new"]


def test_landed_types(spark):
    df = spark.sql("select cast(1 as int) i, cast(2 as smallint) s, cast(1.5 as decimal(5,2)) d, timestamp'2020-01-01 10:00:00' t, null n, 'x' c, true b")
    got = S.landed(df)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "decimal(38,18)", "timestamp_ntz", "string", "string", "boolean"]
    assert got.first().t == dt.datetime(2020, 1, 1, 10)
    with pytest.raises(ValueError):
        S.landed(spark.sql("select array(1) a"))


def test_jdbc_reads_a_database(spark, tmp_path):
    """Through the database that comes with Spark."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark._jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    conn = spark._jvm.java.sql.DriverManager.getConnection(url)
    conn.createStatement().execute("create table t (id int, amount decimal(20, 4), name varchar(9))")
    conn.createStatement().execute("insert into t values (1, 1.5, 'a'), (2, null, null)")
    conn.close()
    got = S.jdbc(spark, url, "t", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert [t for _, t in got.dtypes] == ["bigint", "decimal(38,18)", "string"] and sorted(tuple(r) for r in got.where("id = 1").collect()) == [(1, D("1.5"), "a")]


def test_declared_tables(spark):
    r = S.Registry(spark, SF, ("region",), {"erasure_log": S.EVENT})
    assert r.table("region").count() == 5 and r.table("erasure_log").count() == 0 and r.columns("region")["r_name"] == "string"
    with pytest.raises(KeyError):
        r.table("nation")


def test_decimals_of_json_that_are_none(spark):
    df = spark.createDataFrame([("{",), ('{"a": null}',), ("{}",), (None,)], "e string")
    assert [r[0] for r in df.select(J.json_decimal("e", "a")).collect()] == [None] * 4
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        spark.createDataFrame([('{"a": "x"}',)], "e string").select(J.json_decimal("e", "a")).collect()


def test_optional_source_and_types(spark, tmp_path):
    assert S.optional(spark, f"file://{tmp_path}/none", S.EVENT).count() == 0
    with pytest.raises(ValueError):
        S.column_type("money")


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, "x", -1), (1, "y", 2), (2, None, 3)], "k int, v string, n int")
    assert rows(R.not_unique(df, "k")) == [(1, 2)]
    assert R.is_null(df, "v").count() == 1 and R.not_accepted(df, "v", ["x"]).count() == 1
    assert R.negative(df, "n").count() == 1 and R.under(df, "n", 3).count() == 2
    assert R.orphans(df, "v", spark.createDataFrame([("x",)], "v string"), "v").count() == 1
    assert R.except_both_ways(df, df).count() == 0
