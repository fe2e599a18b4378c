"""Queries over the driver's tables and their DuckDB equivalents, each over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.functions import jsonx as J
from quillstone.operators import relational as R
from quillstone.plans import marts as M
from quillstone.sources import tables as S
from quillstone.streaming import erasure as X
from quillstone.streaming import extract as E
from quillstone.streaming import ingest as I

CUTOFF, LATER = "1995-06-17 00:00:00", "1995-09-17 00:00:00"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return S.table(spark, d, name)


def scd2_versions(spark, d):
    e = R.scd2(S.events(spark, d), "id", "sequence", "recorded_at")
    return e.select("id", "version_number", "event_type", "valid_from", "valid_to", "is_current")


def scd2_single_current(spark, d):
    return R.not_one_current(R.scd2(S.events(spark, d), "id", "sequence", "recorded_at"), "id")


def latest_per_key(spark, d):
    return R.latest_per_key(S.events(spark, d), ["id"], ["sequence"]).select("id", "sequence", "event_type", "recorded_at")


def first_per_key(spark, d):
    return R.first_per_key(S.events(spark, d), ["id", "event_type"], ["sequence"]).select("id", "event_type", "sequence", "recorded_at")


def json_extract(spark, d):
    e = S.events(spark, d)
    return e.select("outbox_sequence", J.json_string("event", "k").alias("k_text"), J.json_decimal("event", "k").alias("k_decimal"), J.json_int("event", "k").alias("k_int"), J.json_string("event", "absent").alias("absent"), F.lower("event_type").alias("event_type"))


def membership(spark, d):
    """Changes of membership: the last of each pair wins, then only additions stay."""
    e = S.events(spark, d).where(F.col("event_type").isin("signup", "error"))
    change = e.select("id", S.padded("M", J.json_int("event", "k"), 10).alias("member_id"), F.when(F.col("event_type") == "signup", "added").when(F.col("event_type") == "error", "removed").alias("change"), "outbox_sequence", "recorded_at")
    last = R.latest_per_key(change, ["id", "member_id"], ["outbox_sequence"]).where("change = 'added'")
    return last.select(F.concat(F.lit("U"), F.substring("id", 2, 10)).alias("account_set_id"), "member_id", F.col("recorded_at").alias("member_since"))


def sequence_gaps(spark, d):
    """The stream without its errors has gaps; the whole stream has none."""
    whole = R.sequence_gaps(S.events(spark, d)).withColumn("stream", F.lit("whole"))
    holed = R.sequence_gaps(S.events(spark, d).where("event_type <> 'error'")).withColumn("stream", F.lit("without_errors"))
    return whole.unionByName(holed).select("stream", "entity_id", "min_sequence", "max_sequence", "event_count")


def per_layer_seeded(spark, d):
    """The control by layer over entries of which some credits were moved to another layer, so that only layers differ."""
    e = M.fct_entries(spark, d)
    moved = (F.col("direction") == "credit") & (F.col("entry_sequence") == 3)
    return M.unequal(e.withColumn("layer", F.when(moved, "encumbrance").otherwise(F.col("layer"))), ["transaction_id", "currency", "layer"])


def scd2_current_seeded(spark, d):
    """The control over versions whose latest isn't current where it is an error."""
    v = R.scd2(S.events(spark, d), "id", "sequence", "recorded_at")
    return R.not_one_current(v.withColumn("is_current", F.col("is_current") & (F.col("event_type") != "error")), "id")


def json_values(spark, d):
    """Every typed read, of nested documents made from the events."""
    k = J.json_string("event", "k")
    doc = F.concat(F.lit('{"a":{"b":{"id":"x'), k, F.lit('"}},"flag":'), F.when(F.col("event_type") == "error", "true").otherwise("false"), F.lit(',"when":"2020-01-01T15:29:45+02:00","units":'), k, F.lit('.500000000000000001,"none":null,"word":"null","tags":["p","q'), k, F.lit('"]}'))
    e = S.events(spark, d).select("outbox_sequence", doc.alias("doc"))
    tags = J.json_string_array("doc", "tags")
    return e.select("outbox_sequence", J.json_string("doc", "a.b.id").alias("nested"), J.json_bool("doc", "flag").alias("flag"), J.json_timestamp("doc", "when").alias("at"), J.json_decimal("doc", "units").alias("units"), J.json_object("doc", "a").alias("part"), J.json_object("doc", "none").alias("none"), J.json_object("doc", "word").alias("word"), F.array_join(tags, "|").alias("tags"), J.array_has(tags, "q7").alias("has_q7"))


def stream_totals(spark, d):
    """One row over the whole stream."""
    return S.events(spark, d).agg(F.count(F.lit(1)).alias("events"), F.count_distinct("id").alias("entities"), F.max("outbox_sequence").alias("highest"), F.coalesce(F.sum(F.when(F.col("event_type") == "none such", 1)), F.lit(0)).cast("bigint").alias("nothing"))


def balance_unpivot(spark, d):
    return M.persisted_balances(spark, d)


def history_unpivot(spark, d):
    return M.balances_as_of(spark, d, CUTOFF)


def reconcile_as_of(spark, d):
    """The leaf control as of a time, of which the ledger's side is that of a later one, so that amounts differ."""
    later = M.balances_as_of(spark, d, LATER)
    return M.leaf_reconcile(spark, d, later, CUTOFF)


def as_of_version(spark, d):
    p = R.as_of(M.projection(spark, d), ["journal_id", "account_id", "currency"], "version", "recorded_at", F.lit(CUTOFF).cast("timestamp_ntz"))
    return p.select("journal_id", "account_id", "currency", "version", "settled_dr", "settled_cr", "pending_dr", "pending_cr")


def unbalanced(spark, d):
    """The control over entries whose discounted credits were seeded to differ."""
    e = M.fct_entries(spark, d).withColumn("credit_units", F.when(F.col("entry_sequence") == 3, F.col("credit_units") + F.lit(1).cast("decimal(38,18)")).otherwise(F.col("credit_units")).cast("decimal(38,18)"))
    return M.unequal(e, ["transaction_id", "currency"])


def incremental_load(spark, d):
    """Each id's events above its watermark, where the first half of the outbox is loaded already."""
    e = S.events(spark, d)
    half = e.agg((F.max("outbox_sequence") / 2).cast("bigint").alias("half"))
    loaded = e.crossJoin(F.broadcast(half)).where("outbox_sequence <= half").drop("half")
    return I.newer_than(e, I.watermarks(loaded)).select("id", "sequence", "event_type", "recorded_at")


def reload_erased(spark, d):
    """What a load takes besides: all events of ids that were erased, below their watermark too, up to a time."""
    e = S.events(spark, d)
    top = e.agg(F.max("recorded_at").alias("t")).first()["t"]
    return I.newer_than(e, I.watermarks(e.where("value < 50")), again=e.where("event_type = 'error'"), until=top - dt.timedelta(days=1)).select("id", "sequence", "event_type")


def _outbox(spark, d) -> DataFrame:
    """The events as an outbox: signups announce sets, errors are placeholders, all others announce accounts."""
    e = S.events(spark, d)
    kind = F.when(F.col("event_type") == "signup", "account_set").otherwise("account")
    body = F.concat(F.lit('{"type":"'), kind, F.lit('_updated","'), kind, F.lit('":{"id":"'), F.col("id"), F.lit('","name":"n'), J.json_string("event", "k"), F.lit('","metadata":{"k":'), J.json_string("event", "k"), F.lit("}}}"))
    return e.select(F.col("outbox_sequence").alias("sequence"), F.when(F.col("event_type") != "error", body).alias("payload"), "recorded_at")


def announced_ids(spark, d):
    return E.announced(_outbox(spark, d))


def outbox_range(spark, d):
    """The outbox above the middle of its sequences, placeholders too."""
    o = _outbox(spark, d)
    half = o.agg((F.max("sequence") / 2).cast("bigint").alias("half")).first()["half"]
    return E.outbox_above(o, half).select("sequence", F.col("payload").isNull().alias("is_placeholder"))


def _landed(spark, d) -> dict[str, DataFrame]:
    """Three copies of an account's values: its events, of which signups have no name, its state, and the outbox."""
    e = S.events(spark, d)
    k = J.json_string("event", "k")
    name = F.when(F.col("event_type") == "signup", "null").otherwise(F.concat(F.lit('"n'), k, F.lit('"')))
    doc = F.concat(F.lit('{"type":"'), F.col("event_type"), F.lit('","values":{"name":'), name, F.lit(',"units":'), k, F.lit(".500000000000000001}}"))
    last = R.latest_per_key(e, ["id"], ["sequence"])
    return {
        "account_events": e.select("id", "sequence", "event_type", doc.alias("event"), "outbox_sequence"),
        "accounts": last.select("id", F.concat(F.lit("n"), k).alias("name"), F.lit(None).cast("string").alias("external_id")),
        "outbox": _outbox(spark, d),
    }


def _requests(spark, d) -> DataFrame:
    """A request for each account with an error in its stream, and one for an account that isn't there."""
    asked = S.events(spark, d).where("event_type = 'error'").select("id").distinct().unionByName(spark.createDataFrame([("U9999999999",)], "id string"))
    nothing = F.lit(None).cast("string")
    return asked.select(F.concat(F.lit("R-"), "id").alias("erasure_id"), F.lit("account").alias("entity_kind"), F.col("id").alias("entity_id"), F.lit("operator").alias("source"), F.lit("desk").alias("requested_by"), nothing.alias("reason"), nothing.alias("cascade_of"))


_LOGGED = ["erasure_id", "source", "requested_by", "entity_kind", "entity_id", "table_name", "rows_matched", "rows_redacted"]


def erasure_log(spark, d):
    """What the log says after all requests have been applied to every copy."""
    return X.applied(_landed(spark, d), _requests(spark, d), "run", dt.datetime(2020, 1, 1))[1].select(*_LOGGED)


def erasure_reapply(spark, d):
    """What a run logs that lands the upper half of the outbox and all state again, with values that had been erased."""
    landed = _landed(spark, d)
    half = landed["outbox"].agg((F.max("sequence") / 2).cast("bigint").alias("half")).first()["half"]
    landed["outbox"], landed["account_events"] = landed["outbox"].where(F.col("sequence") > half), landed["account_events"].where(F.col("outbox_sequence") > half)
    return X.applied(landed, _requests(spark, d), "run", dt.datetime(2020, 1, 1), again=True)[1].select(*_LOGGED)


def _log(spark, d) -> DataFrame:
    """The events as an erasure log: clicks are reapplications, the others requests of their id."""
    e = S.events(spark, d)
    nothing = F.lit(None).cast("string")
    source = F.when(F.col("event_type") == "click", "reapply").when(F.col("event_type") == "signup", "forget_event").otherwise("operator")
    return e.select(F.col("outbox_sequence").cast("string").alias("log_id"), F.concat(F.lit("R-"), "id", F.pmod(F.col("sequence"), F.lit(3)).cast("string")).alias("erasure_id"), F.col("recorded_at").alias("applied_at"), F.lit("run").alias("run_id"), source.alias("source"), F.concat(F.lit("by "), "event_type").alias("requested_by"), nothing.alias("reason"), F.lit("account").alias("entity_kind"), F.col("id").alias("entity_id"), nothing.alias("cascade_of"), F.concat(F.lit("t"), F.pmod(F.col("sequence"), F.lit(5)).cast("string")).alias("table_name"), nothing.alias("fields"), J.json_int("event", "k").alias("rows_matched"), J.json_int("event", "k").alias("rows_redacted"))


def erasure_known(spark, d):
    return X.known(_log(spark, d)).select("erasure_id", "entity_kind", "entity_id", "source")


def forget_requests(spark, d):
    """Requests that errors in the stream file, but for ids whose stream filed one before."""
    log = _log(spark, d).where("entity_id < 'U0000000040'")
    return X.forget_requests({"account_events": S.events(spark, d)}, log, ("error",)).select("entity_kind", "entity_id", "source", "requested_by", "reason")


def outbox_gaps(spark, d):
    """Ranges of holes in the outbox without its errors."""
    return I.gaps(S.events(spark, d).where("event_type <> 'error'"), "outbox_sequence")


def keyed_fetch(spark, d):
    touched = S.events(spark, d).where("event_type = 'signup'").select("id").distinct()
    return S.events(spark, d).join(touched, "id", "left_semi").select("id", "sequence", "event_type")


def anti_filed(spark, d):
    e = S.events(spark, d)
    filed = e.where("event_type = 'signup'").select("id").distinct()
    return R.first_per_key(e.where("event_type = 'error'").join(filed, "id", "left_anti"), ["id"], ["sequence"]).select("id", "sequence", "recorded_at")


def anti_filed_seeded(spark, d):
    """The same where only signups of the largest values were filed."""
    e = S.events(spark, d)
    filed = e.where(F.col("event_type") == "signup").where(J.json_int("event", "k") > 90).select("id").distinct()
    return R.first_per_key(e.where("event_type = 'error'").join(filed, "id", "left_anti"), ["id"], ["sequence"]).select("id", "sequence", "recorded_at")


def erasure_redact(spark, d):
    """The accounts' events after all requests; numbers keep their digits."""
    e = _landed(spark, d)["account_events"]
    hit = X.redacted(e, "account_events", X.wanted(_requests(spark, d)))
    done = hit.withColumn("redacted", F.expr("aggregate(_found, 0L, (t, x) -> t + x.n)")).drop("_found")
    return R.merge_on_key(e.withColumn("redacted", F.lit(0).cast("bigint")), done, ["id", "sequence"])


def erasure_survivors(spark, d):
    """Personal values that all copies, and a model, still have of erased ids if nothing had been redacted."""
    landed = _landed(spark, d)
    return X.survivors(landed | {"account:dim_accounts": landed["accounts"]}, _requests(spark, d))


def erasure_summary(spark, d):
    return X.summary(_log(spark, d))


def except_equality(spark, d):
    a = M.balances(M.fct_entries(spark, d)).select(*M.GRAIN, "dr_balance", "cr_balance")
    return R.except_both_ways(a, M.persisted_balances(spark, d).select(*a.columns).where("layer = 'settled'"))


def fk_orphans(spark, d):
    return R.orphans(_t(spark, d, "lineitem"), "l_suppkey", _t(spark, d, "supplier").where("s_acctbal > 0"), "s_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


def unique_combination(spark, d):
    return R.not_unique(_t(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


def accepted_values(spark, d):
    return R.not_accepted(_t(spark, d, "orders"), "o_orderstatus", ["F", "O"]).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def non_negative(spark, d):
    return R.negative(_t(spark, d, "customer"), "c_acctbal").select("c_custkey", S.money("c_acctbal").alias("c_acctbal"))


def midpoint_quantile(spark, d):
    return _t(spark, d, "events").groupBy("event_type").agg(F.percentile(F.unix_micros(F.col("ts").cast("timestamp")), 0.5).cast("bigint").alias("midpoint_us"))


def top_balances(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", "o_custkey", S.money("o_totalprice").alias("total")).orderBy(F.desc("total"), "o_orderkey").limit(100)


def status_counts(spark, d):
    return M.leaf_reconcile(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def reconcile_seeded(spark, d):
    """The leaf control where the projection lacks a journal and the entries lack a currency, so that every status occurs."""
    theirs = M.persisted_balances(spark, d).where("journal_id <> 'J0001'")
    mine = M.balances(M.fct_entries(spark, d)).where("currency <> 'A'").withColumn("dr_balance", F.when(F.col("journal_id") == "J0002", F.col("dr_balance") + F.lit(1).cast("decimal(38,18)")).otherwise(F.col("dr_balance")).cast("decimal(38,18)"))
    return R.reconcile(theirs, mine, M.GRAIN)


def queries() -> dict:
    return {
        "trial_balance": M.trial_balance,
        "fct_entries": M.fct_entries,
        "account_balances": M.fct_account_balances,
        "transactions_balanced": M.fct_transactions,
        "debits_equal_credits": lambda s, d: M.unequal(M.fct_entries(s, d), ["transaction_id", "currency"]),
        "debits_equal_credits_per_layer": lambda s, d: M.unequal(M.fct_entries(s, d), ["transaction_id", "currency", "layer"]),
        "debits_equal_credits_seeded": unbalanced,
        "sequence_gaps": sequence_gaps,
        "scd2_versions": scd2_versions,
        "scd2_single_current": scd2_single_current,
        "scd2_current_seeded": scd2_current_seeded,
        "debits_equal_credits_per_layer_seeded": per_layer_seeded,
        "json_values": json_values,
        "stream_totals": stream_totals,
        "history_unpivot": history_unpivot,
        "reconcile_as_of": reconcile_as_of,
        "reload_erased": reload_erased,
        "announced_ids": announced_ids,
        "outbox_range": outbox_range,
        "erasure_log": erasure_log,
        "erasure_reapply": erasure_reapply,
        "erasure_known": erasure_known,
        "forget_requests": forget_requests,
        "anti_filed_seeded": anti_filed_seeded,
        "latest_per_key": latest_per_key,
        "first_per_key": first_per_key,
        "json_extract": json_extract,
        "membership_current": membership,
        "closure": M.dim_account_set_members,
        "set_dim": M.dim_account_sets,
        "leaf_reconcile": M.leaf_reconcile,
        "leaf_reconcile_seeded": reconcile_seeded,
        "leaf_reconcile_status": status_counts,
        "set_rollup_reconcile": M.set_reconcile,
        "balance_unpivot": balance_unpivot,
        "running_balance": M.running_chain,
        "last_n_chain": lambda s, d: M.running_chain(s, d, 3),
        "as_of_balance": lambda s, d: M.trial_balance(s, d, as_of=CUTOFF),
        "as_of_version": as_of_version,
        "incremental_load": incremental_load,
        "outbox_watermark": outbox_gaps,
        "keyed_fetch": keyed_fetch,
        "anti_filed": anti_filed,
        "erasure_redact": erasure_redact,
        "erasure_survivors": erasure_survivors,
        "erasure_summary": erasure_summary,
        "except_equality": except_equality,
        "fk_orphans": fk_orphans,
        "unique_combination": unique_combination,
        "accepted_values": accepted_values,
        "non_negative": non_negative,
        "midpoint_quantile": midpoint_quantile,
        "top_balances": top_balances,
    }


def oracle_sql() -> dict[str, str]:
    from quillstone.plans.oracle import SQL

    return SQL
