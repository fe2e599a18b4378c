"""Erasure of personal fields in every landed copy, the log of it, and the proof that it holds.

What is personal is a table, ``PLACES``: a row says that a relation holds a copy of an
entity's values, under which id, in which form and fields. An erasure is a request for
one entity; all requests of a run are applied together, one rewrite for each relation
they touch. Amounts, ids and sequences stay: redaction sets a value to JSON null, keeps
absent keys absent, keeps the order of keys and the digits of numbers, and parses only
the documents of erased ids.

The relations are given by name as DataFrames; ``extract.Landing`` has them as versioned
tables. What is computed here is lazy and pure; only ``Landing`` writes.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.relational import first_per_key

#: Who asks: an operator, the entity's own stream, a request for its account, or a run that found the values again.
SOURCES = ("operator", "forget_event", "cascade", "reapply")
FORGET_EVENTS = ("forgot",)

REQUEST = "erasure_id string, entity_kind string, entity_id string, source string, requested_by string, reason string, cascade_of string"
LOG = "log_id string, erasure_id string, applied_at timestamp_ntz, run_id string, source string, requested_by string, reason string, entity_kind string, entity_id string, cascade_of string, table_name string, fields string, rows_matched bigint, rows_redacted bigint"


@dataclass(frozen=True)
class Place:
    kind: str
    relation: str
    form: str  # "json": documents in ``column``; "columns": plain columns
    column: str
    id: str  # the id's column, or its path in the document
    fields: tuple[str, ...]

    def entity_id(self) -> Column:
        return F.get_json_object(self.column, f"$.{self.id}") if "." in self.id else F.col(self.id)


def _places() -> tuple[Place, ...]:
    # Kind, personal fields of its values, personal columns of its state table.
    personal = (
        ("account", "name description external_id metadata", "name external_id"),
        ("account_set", "name description external_id metadata", "name external_id"),
        ("transaction", "description external_id metadata", "external_id"),
        ("entry", "description metadata", ""),
        ("journal", "name description", "name"),
    )
    out = []
    for kind, values, columns in personal:
        out.append(Place(kind, f"{kind}_events", "json", "event", "id", tuple(f"values.{f}" for f in values.split())))
        out.append(Place(kind, "outbox", "json", "payload", f"{kind}.id", tuple(f"{kind}.{f}" for f in values.split())))
        if columns:
            out.append(Place(kind, state_of(kind), "columns", "", "id", tuple(columns.split())))
    return tuple(out)


def state_of(kind: str) -> str:
    """The name of a kind's state table."""
    return "entries" if kind == "entry" else f"{kind}s"


PLACES = _places()
KINDS = tuple(dict.fromkeys(p.kind for p in PLACES))
#: An account set and its backing account have one id: a request for either is one for both.
SAME_ID = {"account": ("account", "account_set"), "account_set": ("account_set", "account")}
#: The columns that tell the rows of a relation apart.
ROW_KEYS = {"outbox": ("sequence",)} | {f"{k}_events": ("id", "sequence") for k in KINDS} | {state_of(k): ("id",) for k in KINDS}


def checked_id(text: str) -> str:
    """A UUID in its usual form; anything else is refused."""
    try:
        return str(uuid.UUID(text))
    except (ValueError, AttributeError, TypeError):
        raise ValueError(f"an entity's id is a UUID, not {text!r}") from None


# --- documents -------------------------------------------------------------------


def tree_of(paths: Iterable[str]) -> dict:
    """Dotted paths as nested keys; a path's end has no keys below it."""
    tree: dict = {}
    for path in paths:
        at = tree
        for key in path.split("."):
            at = at.setdefault(key, {})
    return tree


def blank(node, tree: dict) -> int:
    """Set what the tree's ends name to None, in place; how many of them had a value."""
    if not isinstance(node, dict):
        return 0
    n = 0
    for key in tree.keys() & node.keys():
        if tree[key]:
            n += blank(node[key], tree[key])
        elif node[key] is not None:
            node[key], n = None, n + 1
    return n


#: Stands around a number while the document is parsed, so that its digits are kept as they are.
_held = "\ue000"
_number = re.compile(f'"{_held}([-+.0-9eE]+){_held}"')


def redact(doc: str | None, fields: Sequence[str]) -> tuple[str | None, int]:
    """The document with the fields (dotted paths) null, and how many of them were not null before. Numbers keep their digits."""
    if doc is None:
        return None, 0
    whole = json.loads(doc, parse_float=lambda x: f"{_held}{x}{_held}")
    n = blank(whole, tree_of(fields))
    return (_number.sub(r"\1", json.dumps(whole, ensure_ascii=False, separators=(",", ":"))) if n else doc), n


# --- what a set of requests does to a relation -------------------------------------


def wanted(requests: DataFrame) -> DataFrame:
    """(kind, entity_id) of everything that the requests (entity_kind, entity_id) are for, each once."""
    kinds = F.create_map(*[x for k, v in SAME_ID.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    every = F.coalesce(kinds[F.col("entity_kind")], F.array("entity_kind"))
    return requests.select(F.explode(every).alias("kind"), "entity_id").distinct()


def places_of(relation: str, columns: Sequence[str]) -> list[Place]:
    """The places of a relation, with the columns that it has."""
    return [Place(p.kind, p.relation, p.form, p.column, p.id, tuple(f for f in p.fields if p.form == "json" or f in columns)) for p in PLACES if p.relation == relation]


def redacted(rows: DataFrame, relation: str, ids: DataFrame) -> DataFrame:
    """The rows of a relation that hold one of ``ids`` (kind, entity_id), redacted.

    ``_found`` has (kind, entity_id, n) of each entity in the row, n the values taken. A
    row holds as many entities as it has places, at most.
    """
    key, places = list(ROW_KEYS[relation]), places_of(relation, rows.columns)
    there = F.explode(F.array(*[F.struct(F.lit(p.kind).alias("kind"), p.entity_id().alias("entity_id")) for p in places]))
    found = rows.select(*key, there.alias("x")).select(*key, "x.*").where("entity_id is not null").join(ids, ["kind", "entity_id"], "left_semi")
    found = found.groupBy(*key).agg(F.collect_set(F.struct("kind", "entity_id")).alias("_found"))
    hit = rows.join(found, key)
    if places[0].form == "columns":
        held = F.lit(False)
        for f in places[0].fields:
            held = held | F.col(f).isNotNull()
        n = F.when(held, 1).otherwise(0).cast("bigint")
        hit = hit.withColumn("_found", F.transform("_found", lambda x: F.struct(x["kind"].alias("kind"), x["entity_id"].alias("entity_id"), n.alias("n"))))
        return hit.select(*[F.lit(None).cast(t).alias(c) if c in places[0].fields else F.col(c) for c, t in rows.dtypes], "_found")

    fields = {p.kind: p.fields for p in places}

    @F.pandas_udf("doc string, n array<bigint>")
    def run(docs: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        out = []
        for doc, found in zip(docs, kinds, strict=True):
            taken = []
            for kind in found:
                doc, n = redact(doc, fields[kind])
                taken.append(n)
            out.append((doc, taken))
        return pd.DataFrame(out, columns=["doc", "n"])

    column = places[0].column
    hit = hit.withColumn("_r", run(F.col(column), F.col("_found.kind"))).withColumn(column, F.col("_r.doc"))
    hit = hit.withColumn("_found", F.zip_with("_found", "_r.n", lambda x, n: F.struct(x["kind"].alias("kind"), x["entity_id"].alias("entity_id"), n.alias("n"))))
    return hit.select(*rows.columns, "_found")


def counts(hit: DataFrame, relation: str) -> DataFrame:
    """(kind, entity_id, table_name, rows_matched, rows_redacted) of the rows that ``redacted`` gave."""
    each = hit.select(F.explode("_found").alias("x")).select("x.*")
    return each.groupBy("kind", "entity_id").agg(F.lit(relation).alias("table_name"), F.count(F.lit(1)).alias("rows_matched"), F.count_if(F.col("n") > 0).alias("rows_redacted"))


def log_rows(requests: DataFrame, touched: DataFrame, run_id: str, when, again: bool = False) -> DataFrame:
    """The log: a row for each request and table that holds its entity.

    A request that matched nothing has one row without counts, so that it is on record.
    ``again``: only tables in which something was redacted are logged, as reapplied.
    """
    spark = requests.sparkSession
    own = spark.createDataFrame([(k, other) for k in KINDS for other in SAME_ID.get(k, (k,))], "entity_kind string, kind string")
    named = spark.createDataFrame([(k, t, json.dumps([f for o in SAME_ID.get(k, (k,)) for p in PLACES if p.kind == o and p.relation == t for f in p.fields])) for k in KINDS for t in {p.relation for o in SAME_ID.get(k, (k,)) for p in PLACES if p.kind == o}], "entity_kind string, table_name string, fields string")
    sums = touched.join(F.broadcast(own), "kind").groupBy("entity_kind", "entity_id", "table_name").agg(F.sum("rows_matched").alias("rows_matched"), F.sum("rows_redacted").alias("rows_redacted"))
    rows = requests.join(sums, ["entity_kind", "entity_id"], "inner" if again else "left")
    if again:
        rows = rows.where("rows_redacted > 0").withColumns({"source": F.lit("reapply"), "requested_by": F.lit(None).cast("string"), "reason": F.lit(None).cast("string"), "cascade_of": F.lit(None).cast("string")})
    zero = F.lit(0).cast("bigint")
    rows = rows.withColumns({"table_name": F.coalesce("table_name", F.concat("entity_kind", F.lit("_events"))), "rows_matched": F.coalesce("rows_matched", zero), "rows_redacted": F.coalesce("rows_redacted", zero)})
    rows = rows.join(F.broadcast(named), ["entity_kind", "table_name"], "left").withColumns({"run_id": F.lit(run_id), "applied_at": F.lit(when).cast("timestamp_ntz")})
    return rows.withColumn("log_id", F.md5(F.concat_ws("|", "erasure_id", "run_id", "source", "table_name"))).select(*[c.split(" ")[0] for c in LOG.split(", ")])


def applied(relations: Mapping[str, DataFrame], requests: DataFrame, run_id: str, when, again: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """For each relation the rows that the requests change or match, redacted, and the log of it. Nothing is written."""
    ids = wanted(requests)
    hits = {name: redacted(rows, name, ids) for name, rows in relations.items() if any(p.relation == name and (p.form == "json" or set(p.fields) & set(rows.columns)) for p in PLACES)}
    touched = requests.sparkSession.createDataFrame([], "kind string, entity_id string, table_name string, rows_matched bigint, rows_redacted bigint")
    for name, hit in hits.items():
        touched = touched.unionByName(counts(hit, name))
    return hits, log_rows(requests, touched, run_id, when, again)


# --- requests ----------------------------------------------------------------------


def request(spark: SparkSession, kind: str, entity: str, source: str = "operator", requested_by: str | None = None, reason: str | None = None) -> DataFrame:
    """One request; an unknown kind or source, or an id that is no UUID, is refused."""
    if kind not in KINDS:
        raise ValueError(f"no kind {kind!r}; there are {', '.join(KINDS)}")
    if source not in SOURCES:
        raise ValueError(f"no source {source!r}; there are {', '.join(SOURCES)}")
    return spark.createDataFrame([(str(uuid.uuid4()), kind, checked_id(entity), source, requested_by, reason, None)], REQUEST)


def cascade(requests: DataFrame, entries: DataFrame) -> DataFrame:
    """Requests for the entries (id, account_id) of erased accounts, each with the request that it comes from."""
    accounts = requests.where("entity_kind = 'account'").select(F.col("entity_id").alias("account_id"), F.col("erasure_id").alias("cascade_of"), "requested_by", "reason")
    each = entries.select("id", "account_id").distinct().join(accounts, "account_id")
    return each.select(_derived_id("cascade_of", "id").alias("erasure_id"), F.lit("entry").alias("entity_kind"), F.col("id").alias("entity_id"), F.lit("cascade").alias("source"), "requested_by", "reason", "cascade_of")


def _derived_id(*parts: str | Column) -> Column:
    """A UUID-shaped id that is the same whenever it is computed."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def forget_requests(streams: Mapping[str, DataFrame], log: DataFrame, types: Sequence[str] = FORGET_EVENTS) -> DataFrame:
    """A request for each entity whose stream says to forget it, unless its stream said so before.

    ``streams``: the events that a run has just landed, by relation; of an entity's the first asks.
    """
    out = log.sparkSession.createDataFrame([], REQUEST)
    filed = log.where("source = 'forget_event'").select("entity_kind", F.col("entity_id").alias("id")).distinct()
    for kind in KINDS:
        if f"{kind}_events" in streams and types:
            asked = streams[f"{kind}_events"].where(F.col("event_type").isin(*types)).join(filed.where(F.col("entity_kind") == kind).select("id"), "id", "left_anti")
            first = first_per_key(asked, ["id"], ["sequence"])
            why = F.concat("event_type", F.lit(" event at sequence "), F.col("sequence").cast("string"), F.lit(f" on {kind}_events"))
            out = out.unionByName(first.select(_derived_id(F.lit(kind), "id", why).alias("erasure_id"), F.lit(kind).alias("entity_kind"), F.col("id").alias("entity_id"), F.lit("forget_event").alias("source"), F.lit("upstream").alias("requested_by"), why.alias("reason"), F.lit(None).cast("string").alias("cascade_of")))
    return out


def known(log: DataFrame) -> DataFrame:
    """The standing requests of a log, as requests: of each entity the oldest that is no reapplication."""
    first = first_per_key(log.where("source <> 'reapply'"), ["entity_kind", "entity_id"], ["applied_at", "erasure_id"])
    nothing = F.lit(None).cast("string")
    return first.select("erasure_id", "entity_kind", "entity_id", "source", nothing.alias("requested_by"), nothing.alias("reason"), nothing.alias("cascade_of"))


def summary(log: DataFrame) -> DataFrame:
    """A row for each request: who asked for what, its first application, what it took, and how often it was reapplied."""
    first = first_per_key(log.where("source <> 'reapply'"), ["erasure_id"], ["applied_at", "log_id"])
    first = first.select("erasure_id", "entity_kind", "entity_id", F.col("source").alias("erasure_source"), "requested_by", "reason", "cascade_of", "run_id")
    each = log.groupBy("erasure_id").agg(
        F.min("applied_at").alias("first_applied_at"),
        F.count_distinct("table_name").alias("tables_touched"),
        F.sum("rows_redacted").alias("rows_redacted_total"),
        F.count_if(F.col("source") == "reapply").alias("reapply_count"),
        F.max(F.when(F.col("source") == "reapply", F.col("applied_at"))).alias("last_reapplied_at"),
    )
    return first.join(each, "erasure_id")


def survivors(relations: Mapping[str, DataFrame], log: DataFrame) -> DataFrame:
    """(relation, entity_kind, entity_id, field) of personal values that erased entities still have anywhere; empty strings count.

    Every place of every relation that is given is looked at, whatever the log counted.
    A relation may also be a model: one with a column for each of its kind's fields, and
    its id in a column ``id``, under the name ``<kind>:<relation>``.
    """
    erased = log.select("entity_kind", "entity_id").distinct()
    same = log.sparkSession.createDataFrame([(k, other) for k in KINDS for other in SAME_ID.get(k, (k,))], "entity_kind string, kind string")
    erased = erased.join(F.broadcast(same), "entity_kind")
    out = log.sparkSession.createDataFrame([], "relation string, entity_kind string, entity_id string, field string")
    for name, rows in relations.items():
        kind, _, model = name.rpartition(":")
        places = [Place(kind, model, "columns", "", "id", tuple(f.rpartition(".")[2] for p in PLACES if p.kind == kind and p.form == "json" and p.column == "event" for f in p.fields if f.rpartition(".")[2] in rows.columns))] if kind else places_of(name, rows.columns)
        for p in places:
            if p.fields:
                value = lambda f, p=p: F.get_json_object(p.column, f"$.{f}") if p.form == "json" else F.col(f).cast("string")
                each = rows.select(p.entity_id().alias("entity_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), value(f).alias("value")) for f in p.fields])).alias("x")).where("x.value is not null and entity_id is not null")
                got = each.join(erased.where(F.col("kind") == p.kind).select("entity_kind", "entity_id"), "entity_id")
                out = out.unionByName(got.select(F.lit(model).alias("relation"), "entity_kind", "entity_id", "x.field"))
    return out.distinct()
