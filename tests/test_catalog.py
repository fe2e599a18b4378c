"""The query surface over the smallest tables, and against the models that it answers from."""

import datetime as dt
import decimal
import json
import uuid

import pytest
from pyspark.sql import functions as F

from quillstone.plans import catalog as C
from quillstone.plans import marts as M
from quillstone.streaming import erasure as X

SF = "/root/testdata/sf0.001"
D = decimal.Decimal


def test_values_as_json():
    nested = {"a": [D("1.500000000000000000"), D("0E-18"), D("-12345678901234567890.123456789012345678"), D("1E+3")], 1: (dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3), None, True, uuid.UUID(int=1))}
    assert C.plain(nested) == {"a": ["1.5", "0", "-12345678901234567890.123456789012345678", "1000"], "1": ["2020-01-02", "2020-01-02T03:00:00.000000", None, True, str(uuid.UUID(int=1))]}
    assert json.dumps(C.plain(nested))


def test_times_and_ids():
    assert C.instant("2020-01-01T15:29:45+02:00") == dt.datetime(2020, 1, 1, 13, 29, 45) and C.instant(None) is None and C.instant("2020-01-01") == dt.datetime(2020, 1, 1)
    assert C.entity_id(str(uuid.UUID(int=7)).upper()) == str(uuid.UUID(int=7))
    for call in (lambda: C.instant("yesterday"), lambda: C.entity_id("x"), lambda: C.model("none"), lambda: C.model("fct_entries").require("units", "no_such"), lambda: C.model("fct_entries").value("layer", "gold"), lambda: C.model("fct_entries").value("no_such", "x")):
        with pytest.raises(C.CallerError):
            call()
    assert C.model("fct_entries").value("layer", "settled") == "settled" and C.model("fct_entries").value("currency", "anything") == "anything"


def test_models_declare_the_columns_that_they_have(spark):
    assert {m["name"] for m in C.list_models()} == set(C.MODELS)
    for name in C.MODELS:
        d = C.describe(spark, SF, name)
        assert all(c["type"] for c in d["columns"]), name
        assert [c["name"] for c in d["columns"]] == C.MODELS[name].build(spark, SF).columns and set(d["grain"]) <= {c["name"] for c in d["columns"]}
    assert "fct_transactions" in C.describe(spark, SF, "fct_entries")["children"]


def test_trial_balance(spark):
    now = C.trial_balance(spark, SF, "J0001")
    assert now["rows"] and now["is_balanced"] and now["journal_name"] and now["as_of"] is None and now["grain"] == ["currency", "layer"]
    end = C.trial_balance(spark, SF, "J0001", "2100-01-01T00:00:00Z")
    assert end["rows"] == now["rows"] and end["source"] != now["source"]
    for journal, as_of in (("J9999", None), ("J0001", "1900-01-01")):
        none = C.trial_balance(spark, SF, journal, as_of)
        assert none["rows"] == [] and none["is_balanced"] is None and journal in none["note"]


def test_explain_balance(spark):
    b = M.fct_account_balances(spark, SF).where("account_id like 'S%' and entry_count > 5").orderBy(*M.GRAIN).first()
    whole = C.explain_balance(spark, SF, b.account_id, b.currency, b.layer)
    assert len({x["journal_id"] for x in whole}) == len(whole) > 1
    one = C.explain_balance(spark, SF, b.account_id, b.currency, b.layer, b.journal_id, limit=3)
    assert len(one) == 1 and one[0]["entries_shown"] == 3 and one[0]["entries_truncated"] and one[0]["chain_reconciles"] and one[0]["balance_sign"] == "credits less debits"
    assert one[0]["entries"][-1]["position"] == b.entry_count and one[0]["entries"][-1]["running_cr"] == one[0]["cr_balance"] == one[0]["ledger"]["cr_balance"]
    none = C.explain_balance(spark, SF, b.account_id, b.currency, b.layer, b.journal_id, limit=0)
    assert none[0]["entries"] == [] and none[0]["entries_truncated"] and none[0]["chain_reconciles"]
    with pytest.raises(C.CallerError):
        C.explain_balance(spark, SF, b.account_id, b.currency, "gold")
    assert C.explain_balance(spark, SF, "nobody", "A", "settled") == []


def test_reconcile(spark):
    now = C.reconcile(spark, SF)
    assert now["is_reconciled"] and now["mismatches"] == [] and [c["control"] for c in now["controls"]] == ["leaf", "set"] and len(now["caveats"]) == 1
    assert now["controls"][0]["rows_compared"] == M.leaf_reconcile(spark, SF).count()
    end = C.reconcile(spark, SF, "2100-01-01")
    assert [c["rows_by_status"] for c in end["controls"]] == [c["rows_by_status"] for c in now["controls"]] and len(end["caveats"]) == 3 and end["as_of"]
    then = C.reconcile(spark, SF, "1995-06-17")
    assert then["is_reconciled"] and 0 < then["controls"][0]["rows_compared"] < now["controls"][0]["rows_compared"]
    drift = M.persisted_balances(spark, SF).withColumn("dr_balance", (F.col("dr_balance") + F.when(F.col("journal_id") == "J0002", 1).otherwise(0)).cast(M.DEC))
    off = C.reconcile(spark, SF, limit=2, persisted=drift)
    assert not off["is_reconciled"] and off["mismatches_truncated"] and len(off["mismatches"]) == 4 and {m["status"] for m in off["mismatches"]} == {"amount_mismatch"}


def test_erasures(spark):
    row = lambda log, e, source, entity, table, n, at: (log, e, dt.datetime(2020, 1, at), "run", source, "desk", None, "account", entity, None, table, "[]", n, n)
    log = spark.createDataFrame([row("1", "r1", "operator", "a", "accounts", 1, 1), row("2", "r1", "reapply", "a", "accounts", 1, 3), row("3", "r2", "cascade", "b", "outbox", 0, 2), row("4", "r1", "operator", "a", "outbox", 2, 1)], X.LOG)
    every = C.erasures(log)
    assert [r["erasure_id"] for r in every["erasures"]] == ["r2", "r1"] and (every["requests_total"], every["entities_total"], every["reapplies_total"]) == (2, 2, 1)
    assert every["by_source_shown"] == {"operator": 1, "cascade": 1}
    one = C.erasures(log, "a")
    assert [(r["erasure_id"], r["tables_touched"], r["rows_redacted_total"], r["reapply_count"]) for r in one["erasures"]] == [("r1", 2, 4, 1)]
    assert C.erasures(log, "zz")["note"] and C.erasures(log, limit=1)["shown"] == 1 and C.erasures(log, limit=1)["requests_total"] == 2
    assert C.erasures(log.limit(0))["note"] == "nothing has been erased"
