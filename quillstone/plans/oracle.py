"""DuckDB SQL for the registered queries, over the driver's tables."""

from __future__ import annotations

DEC = "DECIMAL(38,18)"
CUTOFF = "1995-06-17 00:00:00"


def _pad(prefix: str, key: str, width: int) -> str:
    return f"('{prefix}' || lpad(({key})::VARCHAR, {width}, '0'))"


ENTRIES = f"""
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, n.n_regionkey,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_shipdate, l_extendedprice, l_quantity) AS n
  FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
),
legs AS (SELECT 'debit' AS direction, 0 AS leg UNION ALL SELECT 'credit', 1),
entries AS (
  SELECT 'E' || lpad(l_orderkey::VARCHAR, 12, '0') || lpad((2 * n + leg)::VARCHAR, 6, '0') AS entry_id, {_pad("T", "l_orderkey", 12)} AS transaction_id,
         {_pad("J", "n_regionkey", 4)} AS journal_id, CASE direction WHEN 'debit' THEN {_pad("C", "o_custkey", 10)} ELSE {_pad("S", "l_suppkey", 10)} END AS account_id,
         l_returnflag AS currency, CASE l_linestatus WHEN 'F' THEN 'settled' ELSE 'pending' END AS layer, direction,
         l_extendedprice::DECIMAL(18,2)::{DEC} AS units,
         CASE direction WHEN 'debit' THEN l_extendedprice::DECIMAL(18,2)::{DEC} ELSE 0::{DEC} END AS debit_units,
         CASE direction WHEN 'credit' THEN l_extendedprice::DECIMAL(18,2)::{DEC} ELSE 0::{DEC} END AS credit_units,
         2 * n + leg AS entry_sequence, o_orderdate::DATE AS effective_date, l_shipdate AS recorded_at
  FROM lines, legs
)"""

BALANCES = f"""{ENTRIES},
balances AS (
  SELECT journal_id, account_id, currency, layer, sum(debit_units)::{DEC} AS dr_balance, sum(credit_units)::{DEC} AS cr_balance, count(*) AS entry_count,
         arg_max(entry_id, (recorded_at, entry_sequence, entry_id)) AS latest_entry_id, min(recorded_at) AS first_entry_at, max(recorded_at) AS last_entry_at
  FROM entries GROUP BY journal_id, account_id, currency, layer
)"""

PROJECTION = f"""{BALANCES},
projection AS (
  SELECT journal_id, account_id, currency, row_number() OVER w AS version, recorded_at,
         sum(CASE layer WHEN 'settled' THEN debit_units ELSE 0 END) OVER w AS settled_dr, sum(CASE layer WHEN 'settled' THEN credit_units ELSE 0 END) OVER w AS settled_cr,
         sum(CASE layer WHEN 'pending' THEN debit_units ELSE 0 END) OVER w AS pending_dr, sum(CASE layer WHEN 'pending' THEN credit_units ELSE 0 END) OVER w AS pending_cr
  FROM entries WINDOW w AS (PARTITION BY journal_id, account_id, currency ORDER BY recorded_at, entry_sequence, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
newest AS (SELECT * FROM projection QUALIFY row_number() OVER (PARTITION BY journal_id, account_id, currency ORDER BY version DESC) = 1),
persisted AS (
  SELECT journal_id, account_id, currency, 'settled' AS layer, settled_dr::{DEC} AS dr_balance, settled_cr::{DEC} AS cr_balance FROM newest
  UNION ALL SELECT journal_id, account_id, currency, 'pending', pending_dr::{DEC}, pending_cr::{DEC} FROM newest
)"""

EVENTS = f"""
ev AS (
  SELECT {_pad("U", "user_id", 10)} AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence, event_type, props AS event, ts AS recorded_at, event_id + 1 AS outbox_sequence, value FROM events
)"""

_SEGMENT = "('G' || lpad((('0x' || substr(md5(c_mktsegment), 1, 8))::BIGINT)::VARCHAR, 10, '0'))"
def _since(key: str) -> str:
    return f"(TIMESTAMP '1992-01-01' + to_days(({key} % 1000)::INTEGER))::TIMESTAMP"


CLOSURE = f"""
edges AS (
  SELECT {_pad("N", "c_nationkey", 10)} AS account_set_id, {_pad("C", "c_custkey", 10)} AS member_id, 'account' AS member_kind, {_since("c_custkey")} AS member_since FROM customer
  UNION ALL SELECT {_pad("N", "s_nationkey", 10)}, {_pad("S", "s_suppkey", 10)}, 'account', {_since("s_suppkey")} FROM supplier
  UNION ALL SELECT {_SEGMENT}, {_pad("C", "c_custkey", 10)}, 'account', {_since("c_custkey")} FROM customer
  UNION ALL SELECT {_pad("R", "n_regionkey", 10)}, {_pad("N", "n_nationkey", 10)}, 'account_set', {_since("n_nationkey")} FROM nation
  UNION ALL SELECT 'T0000000000', {_pad("R", "r_regionkey", 10)}, 'account_set', {_since("r_regionkey")} FROM region
),
members AS (
  SELECT account_set_id, member_id, member_kind, 1::BIGINT AS depth, account_set_id || '/' || member_id AS path, member_since FROM edges
  UNION ALL
  SELECT m.account_set_id, e.member_id, e.member_kind, m.depth + 1, m.path || '/' || e.member_id, greatest(m.member_since, e.member_since)
  FROM members m JOIN edges e ON e.account_set_id = m.member_id WHERE m.member_kind = 'account_set' AND strpos(m.path, e.member_id) = 0
),
sets AS (
  SELECT {_pad("N", "n_nationkey", 10)} AS account_set_id, n_name AS name, {_pad("J", "n_regionkey", 4)} AS journal_id FROM nation
  UNION ALL SELECT {_pad("R", "r_regionkey", 10)}, r_name, {_pad("J", "r_regionkey", 4)} FROM region
)"""


LATER = "1995-09-17 00:00:00"
_K = "json_extract_string(event, '$.k')"
LANDED = f"""{EVENTS},
half AS (SELECT max(outbox_sequence) // 2 AS half FROM ev),
accs AS (SELECT *, '{{"type":"' || event_type || '","values":{{"name":' || CASE event_type WHEN 'signup' THEN 'null' ELSE '"n' || {_K} || '"' END || ',"units":' || {_K} || '.500000000000000001}}}}' AS doc FROM ev),
box AS (SELECT outbox_sequence AS sequence, id, CASE event_type WHEN 'signup' THEN 'account_set' ELSE 'account' END AS kind, event_type = 'error' AS is_placeholder FROM ev),
req AS (SELECT id FROM ev WHERE event_type = 'error' GROUP BY id UNION ALL SELECT 'U9999999999')"""
_LOG = """SELECT 'R-' || req.id AS erasure_id, '{0}' AS source, {1} AS requested_by, 'account' AS entity_kind, req.id AS entity_id, coalesce(table_name, 'account_events') AS table_name, coalesce(m, 0)::BIGINT AS rows_matched, coalesce(r, 0)::BIGINT AS rows_redacted
FROM req {2} JOIN (
  SELECT id, 'account_events' AS table_name, count(*) AS m, count(*) FILTER (WHERE event_type <> 'signup') AS r FROM ev WHERE {3} GROUP BY id
  UNION ALL SELECT DISTINCT id, 'accounts', 1, 1 FROM ev
  UNION ALL SELECT id, 'outbox', count(*), count(*) FROM ev WHERE event_type <> 'error' AND {3} GROUP BY id) c ON c.id = req.id {4}"""
LOG = f"""{EVENTS},
lg AS (SELECT outbox_sequence, 'R-' || id || (sequence % 3) AS erasure_id, recorded_at AS applied_at, CASE event_type WHEN 'click' THEN 'reapply' WHEN 'signup' THEN 'forget_event' ELSE 'operator' END AS source,
  'by ' || event_type AS requested_by, id AS entity_id, 't' || (sequence % 5) AS table_name, {_K}::BIGINT AS rows_redacted FROM ev)"""


def _trial(where: str = "") -> str:
    entries = ENTRIES if not where else f"{ENTRIES.rstrip()[:-1]}  WHERE {where}\n)"
    return f"""WITH {entries},
b AS (SELECT journal_id, account_id, currency, layer, sum(debit_units) AS d, sum(credit_units) AS c, count(*) AS n, max(recorded_at) AS last_at FROM entries GROUP BY ALL)
SELECT b.journal_id, any_value(r_name) AS journal_name, any_value(upper(r_name)) AS journal_code, currency, layer, count(DISTINCT account_id) AS account_count, sum(n)::BIGINT AS entry_count,
       sum(d)::{DEC} AS total_debits, sum(c)::{DEC} AS total_credits, (sum(d) - sum(c))::{DEC} AS difference, sum(d) = sum(c) AS is_balanced, max(last_at) AS as_of
FROM b LEFT JOIN region ON {_pad("J", "r_regionkey", 4)} = b.journal_id GROUP BY b.journal_id, currency, layer"""


def _unequal(keys: str, entries: str = ENTRIES) -> str:
    return f"""WITH {entries} SELECT {keys}, sum(debit_units)::{DEC} AS debits, sum(credit_units)::{DEC} AS credits, (sum(debit_units) - sum(credit_units))::{DEC} AS difference
FROM entries GROUP BY {keys} HAVING sum(debit_units) <> sum(credit_units)"""


def _reconcile(theirs: str, mine: str, id_col: str = "account_id") -> str:
    keys = ("journal_id", id_col, "currency", "layer")
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    return f"""SELECT {", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)}, a.dr_balance AS ledger_dr_balance, a.cr_balance AS ledger_cr_balance, b.dr_balance AS warehouse_dr_balance, b.cr_balance AS warehouse_cr_balance,
       CASE WHEN a.journal_id IS NULL THEN 'missing_in_ledger' WHEN b.journal_id IS NULL AND (a.dr_balance <> 0 OR a.cr_balance <> 0) THEN 'missing_in_warehouse' WHEN b.journal_id IS NULL THEN 'ok_untouched_layer'
            WHEN a.dr_balance <> b.dr_balance OR a.cr_balance <> b.cr_balance THEN 'amount_mismatch' ELSE 'ok' END AS status
FROM {theirs} a FULL OUTER JOIN {mine} b ON {on}"""


def _rollup(name: str) -> str:
    return f"""(SELECT journal_id, account_set_id, currency, layer, sum(dr_balance)::{DEC} AS dr_balance, sum(cr_balance)::{DEC} AS cr_balance FROM {name}
  JOIN (SELECT DISTINCT account_set_id, member_id AS account_id FROM members WHERE member_kind = 'account') USING (account_id) JOIN sets USING (account_set_id, journal_id) GROUP BY ALL)"""


def _at_time(name: str, at: str) -> str:
    last = f"SELECT * FROM projection WHERE recorded_at <= TIMESTAMP '{at}' QUALIFY row_number() OVER (PARTITION BY journal_id, account_id, currency ORDER BY version DESC) = 1"
    return f"""{name}_last AS ({last}), {name} AS (
  SELECT journal_id, account_id, currency, 'settled' AS layer, settled_dr::{DEC} AS dr_balance, settled_cr::{DEC} AS cr_balance FROM {name}_last
  UNION ALL SELECT journal_id, account_id, currency, 'pending', pending_dr::{DEC}, pending_cr::{DEC} FROM {name}_last)"""


_CHAIN = f"""chain AS (
  SELECT journal_id, account_id, currency, layer, entry_id, row_number() OVER w AS position, (sum(debit_units) OVER w)::{DEC} AS running_dr, (sum(credit_units) OVER w)::{DEC} AS running_cr,
         (sum(debit_units) OVER w - sum(credit_units) OVER w)::{DEC} AS running_balance, count(*) OVER (PARTITION BY journal_id, account_id, currency, layer) AS n
  FROM entries WINDOW w AS (PARTITION BY journal_id, account_id, currency, layer ORDER BY recorded_at, entry_sequence, entry_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""
_CHAIN_COLUMNS = "journal_id, account_id, currency, layer, entry_id, position, running_dr, running_cr, running_balance"
_GAPS = "SELECT '{0}' AS stream, id AS entity_id, min(sequence) AS min_sequence, max(sequence) AS max_sequence, count(*) AS event_count FROM ev {1} GROUP BY id HAVING min(sequence) <> 1 OR max(sequence) <> count(*)"

SQL = {
    "trial_balance": _trial(),
    "as_of_balance": _trial(f"l_shipdate <= TIMESTAMP '{CUTOFF}'"),
    "fct_entries": f"WITH {ENTRIES} SELECT entry_id, transaction_id, journal_id, account_id, currency, layer, direction, units, debit_units, credit_units, entry_sequence, effective_date, recorded_at FROM entries",
    "account_balances": f"""WITH {BALANCES} SELECT journal_id, account_id, currency, layer, dr_balance, cr_balance,
  (CASE account_id[1] WHEN 'C' THEN dr_balance - cr_balance ELSE cr_balance - dr_balance END)::{DEC} AS balance, CASE account_id[1] WHEN 'C' THEN 'debit' ELSE 'credit' END AS normal_balance_type,
  entry_count, latest_entry_id, first_entry_at, last_entry_at FROM balances""",
    "transactions_balanced": f"""WITH {ENTRIES}, e AS (SELECT transaction_id, currency, sum(debit_units) = sum(credit_units) AS even FROM entries GROUP BY ALL),
c AS (SELECT transaction_id, any_value(journal_id) AS journal_id, count(*) AS n, count(DISTINCT currency) AS cur, count(DISTINCT layer) AS lay, count(DISTINCT account_id) AS acc FROM entries GROUP BY ALL),
b AS (SELECT transaction_id, bool_and(even) AS is_balanced FROM e GROUP BY ALL)
SELECT t.transaction_id, journal_id, o_orderdate::DATE AS effective_date, o_orderpriority AS description, coalesce(n, 0) AS entry_count, coalesce(cur, 0) AS currency_count, coalesce(lay, 0) AS layer_count, coalesce(acc, 0) AS account_count, is_balanced
FROM (SELECT {_pad("T", "o_orderkey", 12)} AS transaction_id, * FROM orders) t LEFT JOIN c USING (transaction_id) LEFT JOIN b USING (transaction_id)""",
    "debits_equal_credits": _unequal("transaction_id, currency"),
    "debits_equal_credits_per_layer": _unequal("transaction_id, currency, layer"),
    "debits_equal_credits_seeded": f"""WITH {ENTRIES}, s AS (SELECT transaction_id, currency, sum(debit_units) AS d, sum(credit_units + CASE entry_sequence WHEN 3 THEN 1 ELSE 0 END) AS c FROM entries GROUP BY ALL)
SELECT transaction_id, currency, d::{DEC} AS debits, c::{DEC} AS credits, (d - c)::{DEC} AS difference FROM s WHERE d <> c""",
    "sequence_gaps": f"WITH {EVENTS} {_GAPS.format('whole', '')} UNION ALL " + _GAPS.format("without_errors", "WHERE event_type <> 'error'"),
    "scd2_versions": f"""WITH {EVENTS} SELECT id, row_number() OVER w AS version_number, event_type, recorded_at AS valid_from, lead(recorded_at) OVER w AS valid_to, lead(recorded_at) OVER w IS NULL AS is_current FROM ev WINDOW w AS (PARTITION BY id ORDER BY sequence)""",
    "scd2_single_current": f"""WITH {EVENTS}, v AS (SELECT id, lead(recorded_at) OVER (PARTITION BY id ORDER BY sequence) IS NULL AS is_current FROM ev) SELECT id, count(*) FILTER (WHERE is_current) AS n_current FROM v GROUP BY id HAVING count(*) FILTER (WHERE is_current) <> 1""",
    "latest_per_key": f"WITH {EVENTS} SELECT id, sequence, event_type, recorded_at FROM ev QUALIFY row_number() OVER (PARTITION BY id ORDER BY sequence DESC) = 1",
    "first_per_key": f"WITH {EVENTS} SELECT id, event_type, sequence, recorded_at FROM ev QUALIFY row_number() OVER (PARTITION BY id, event_type ORDER BY sequence) = 1",
    "json_extract": f"""WITH {EVENTS} SELECT outbox_sequence, json_extract_string(event, '$.k') AS k_text, json_extract_string(event, '$.k')::{DEC} AS k_decimal, json_extract_string(event, '$.k')::BIGINT AS k_int, json_extract_string(event, '$.absent') AS absent, lower(event_type) AS event_type FROM ev""",
    "membership_current": f"""WITH {EVENTS}, c AS (SELECT id, 'M' || lpad(json_extract_string(event, '$.k'), 10, '0') AS member_id, CASE event_type WHEN 'signup' THEN 'added' WHEN 'error' THEN 'removed' END AS change, outbox_sequence, recorded_at FROM ev WHERE event_type IN ('signup', 'error')),
l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY id, member_id ORDER BY outbox_sequence DESC) = 1)
SELECT id AS account_set_id, member_id, recorded_at AS member_since FROM l WHERE change = 'added'""",
    "closure": f"WITH RECURSIVE {CLOSURE} SELECT account_set_id, member_id, member_kind, depth, path, member_since FROM members",
    "set_dim": f"""WITH RECURSIVE {CLOSURE},
d AS (SELECT account_set_id, count(DISTINCT CASE WHEN depth = 1 AND member_kind = 'account' THEN member_id END) AS da, count(DISTINCT CASE WHEN depth = 1 AND member_kind = 'account_set' THEN member_id END) AS ds, count(DISTINCT CASE WHEN member_kind = 'account' THEN member_id END) AS aa, max(depth) AS sd FROM members GROUP BY 1),
u AS (SELECT member_id AS account_set_id, max(depth) AS up, count(*) FILTER (WHERE depth = 1) AS parents FROM members WHERE member_kind = 'account_set' GROUP BY 1)
SELECT account_set_id, journal_id, name, coalesce(up, 0) AS depth_from_root, up IS NULL AS is_root, coalesce(parents, 0) AS direct_parent_count, coalesce(da, 0) AS direct_account_count, coalesce(ds, 0) AS direct_set_count, coalesce(aa, 0) AS descendant_account_count, coalesce(sd, 0) AS subtree_depth
FROM sets LEFT JOIN d USING (account_set_id) LEFT JOIN u USING (account_set_id)""",
    "leaf_reconcile": f"WITH {PROJECTION} {_reconcile('persisted', 'balances')}",
    "leaf_reconcile_seeded": f"""WITH {PROJECTION}, p AS (SELECT * FROM persisted WHERE journal_id <> 'J0001'),
m AS (SELECT * REPLACE ((dr_balance + CASE journal_id WHEN 'J0002' THEN 1 ELSE 0 END)::{DEC} AS dr_balance) FROM balances WHERE currency <> 'A') {_reconcile('p', 'm')}""",
    "leaf_reconcile_status": f"WITH {PROJECTION} SELECT status, count(*) AS n FROM ({_reconcile('persisted', 'balances')}) GROUP BY status",
    "set_rollup_reconcile": f"WITH RECURSIVE {CLOSURE}, {PROJECTION} {_reconcile(_rollup('persisted'), _rollup('balances'), 'account_set_id')}",
    "balance_unpivot": f"WITH {PROJECTION} SELECT * FROM persisted",
    "running_balance": f"WITH {ENTRIES}, {_CHAIN} SELECT {_CHAIN_COLUMNS} FROM chain",
    "last_n_chain": f"WITH {ENTRIES}, {_CHAIN} SELECT {_CHAIN_COLUMNS} FROM chain WHERE position > n - 3",
    "as_of_version": f"""WITH {PROJECTION} SELECT journal_id, account_id, currency, version, settled_dr::{DEC} AS settled_dr, settled_cr::{DEC} AS settled_cr, pending_dr::{DEC} AS pending_dr, pending_cr::{DEC} AS pending_cr
FROM projection WHERE recorded_at <= TIMESTAMP '{CUTOFF}' QUALIFY row_number() OVER (PARTITION BY journal_id, account_id, currency ORDER BY version DESC) = 1""",
    "incremental_load": f"""WITH {EVENTS}, m AS (SELECT id, max(sequence) AS top FROM ev WHERE outbox_sequence <= (SELECT max(outbox_sequence) // 2 FROM ev) GROUP BY id)
SELECT id, sequence, event_type, recorded_at FROM ev LEFT JOIN m USING (id) WHERE sequence > coalesce(top, 0)""",
    "outbox_watermark": f"""WITH {EVENTS}, g AS (SELECT outbox_sequence AS s, coalesce(lag(outbox_sequence) OVER (ORDER BY outbox_sequence), 0) AS before FROM ev WHERE event_type <> 'error')
SELECT before + 1 AS first_missing, s - 1 AS last_missing FROM g WHERE s - before > 1""",
    "keyed_fetch": f"WITH {EVENTS} SELECT id, sequence, event_type FROM ev WHERE id IN (SELECT id FROM ev WHERE event_type = 'signup')",
    "anti_filed": f"WITH {EVENTS} SELECT id, sequence, recorded_at FROM ev WHERE event_type = 'error' AND id NOT IN (SELECT id FROM ev WHERE event_type = 'signup') QUALIFY row_number() OVER (PARTITION BY id ORDER BY sequence) = 1",
    "anti_filed_seeded": f"""WITH {EVENTS} SELECT id, sequence, recorded_at FROM ev WHERE event_type = 'error' AND id NOT IN (SELECT id FROM ev WHERE event_type = 'signup' AND {_K}::BIGINT > 90) QUALIFY row_number() OVER (PARTITION BY id ORDER BY sequence) = 1""",
    "erasure_redact": f"""WITH {LANDED}, x AS (SELECT id FROM req)
SELECT id, sequence, event_type, CASE WHEN id IN (SELECT id FROM x) THEN '{{"type":"' || event_type || '","values":{{"name":null,"units":' || {_K} || '.500000000000000001}}}}' ELSE doc END AS event, outbox_sequence,
  CASE WHEN id IN (SELECT id FROM x) AND event_type <> 'signup' THEN 1 ELSE 0 END::BIGINT AS redacted FROM accs""",
    "erasure_survivors": f"""WITH {LANDED}
SELECT DISTINCT 'account_events' AS relation, 'account' AS entity_kind, id AS entity_id, 'values.name' AS field FROM ev JOIN req USING (id) WHERE event_type <> 'signup'
UNION ALL SELECT DISTINCT r, 'account', id, 'name' FROM ev JOIN req USING (id), (SELECT 'accounts' AS r UNION ALL SELECT 'dim_accounts')
UNION ALL SELECT DISTINCT 'outbox', 'account', id, kind || f FROM box JOIN req USING (id), (SELECT '.name' AS f UNION ALL SELECT '.metadata') WHERE NOT is_placeholder""",
    "erasure_log": f"WITH {LANDED} " + _LOG.format("operator", "'desk'", "LEFT", "true", ""),
    "erasure_reapply": f"WITH {LANDED} " + _LOG.format("reapply", "NULL::VARCHAR", "", "outbox_sequence > (SELECT half FROM half)", "WHERE r > 0"),
    "erasure_known": f"""WITH {LOG} SELECT erasure_id, 'account' AS entity_kind, entity_id, source FROM lg WHERE source <> 'reapply' QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY applied_at, erasure_id) = 1""",
    "forget_requests": f"""WITH {LOG} SELECT 'account' AS entity_kind, id AS entity_id, 'forget_event' AS source, 'upstream' AS requested_by, event_type || ' event at sequence ' || sequence || ' on account_events' AS reason FROM ev
WHERE event_type = 'error' AND id NOT IN (SELECT entity_id FROM lg WHERE source = 'forget_event' AND entity_id < 'U0000000040') QUALIFY row_number() OVER (PARTITION BY id ORDER BY sequence) = 1""",
    "erasure_summary": f"""WITH {LOG}, f AS (SELECT * FROM lg WHERE source <> 'reapply' QUALIFY row_number() OVER (PARTITION BY erasure_id ORDER BY applied_at, outbox_sequence::VARCHAR) = 1),
p AS (SELECT erasure_id, min(applied_at) AS first_applied_at, count(DISTINCT table_name) AS tables_touched, sum(rows_redacted)::BIGINT AS rows_redacted_total, count(*) FILTER (WHERE source = 'reapply') AS reapply_count, max(applied_at) FILTER (WHERE source = 'reapply') AS last_reapplied_at FROM lg GROUP BY erasure_id)
SELECT erasure_id, 'account' AS entity_kind, entity_id, source AS erasure_source, requested_by, NULL::VARCHAR AS reason, NULL::VARCHAR AS cascade_of, 'run' AS run_id, first_applied_at, tables_touched, rows_redacted_total, reapply_count, last_reapplied_at FROM f JOIN p USING (erasure_id)""",
    "announced_ids": f"""WITH {LANDED} SELECT DISTINCT s AS stream, id FROM box, (SELECT 'account_events' AS s UNION ALL SELECT 'account_set_events') WHERE NOT is_placeholder AND (s = 'account_events' OR kind = 'account_set')""",
    "outbox_range": f"WITH {LANDED} SELECT sequence, is_placeholder FROM box WHERE sequence > (SELECT half FROM half)",
    "reload_erased": f"""WITH {EVENTS}, m AS (SELECT id, max(sequence) AS top FROM ev WHERE value < 50 GROUP BY id), x AS (SELECT DISTINCT id FROM ev WHERE event_type = 'error')
SELECT id, sequence, event_type FROM ev LEFT JOIN m USING (id) WHERE recorded_at <= (SELECT max(recorded_at) FROM ev) - INTERVAL 1 DAY AND (sequence > coalesce(top, 0) OR id IN (SELECT id FROM x))""",
    "scd2_current_seeded": f"""WITH {EVENTS}, v AS (SELECT id, lead(recorded_at) OVER (PARTITION BY id ORDER BY sequence) IS NULL AND event_type <> 'error' AS is_current FROM ev) SELECT id, count(*) FILTER (WHERE is_current) AS n_current FROM v GROUP BY id HAVING count(*) FILTER (WHERE is_current) <> 1""",
    "debits_equal_credits_per_layer_seeded": f"""WITH {ENTRIES}, s AS (SELECT transaction_id, currency, CASE WHEN direction = 'credit' AND entry_sequence = 3 THEN 'encumbrance' ELSE layer END AS layer, sum(debit_units) AS d, sum(credit_units) AS c FROM entries GROUP BY ALL)
SELECT transaction_id, currency, layer, d::{DEC} AS debits, c::{DEC} AS credits, (d - c)::{DEC} AS difference FROM s WHERE d <> c""",
    "json_values": f"""WITH {EVENTS}, x AS (SELECT outbox_sequence, {_K} AS k, '{{"a":{{"b":{{"id":"x' || {_K} || '"}}}},"flag":' || (event_type = 'error')::VARCHAR || ',"when":"2020-01-01T15:29:45+02:00","none":null,"word":"null"}}' AS doc FROM ev)
SELECT outbox_sequence, json_extract_string(doc, '$.a.b.id') AS nested, json_extract_string(doc, '$.flag')::BOOLEAN AS flag, TIMESTAMP '2020-01-01 13:29:45' AS at, (k || '.500000000000000001')::{DEC} AS units,
  json_extract(doc, '$.a')::VARCHAR AS part, nullif(json_extract_string(doc, '$.none'), 'null') AS none, nullif(json_extract_string(doc, '$.word'), 'null') AS word, 'p|q' || k AS tags, k = '7' AS has_q7 FROM x""",
    "stream_totals": f"WITH {EVENTS} SELECT count(*) AS events, count(DISTINCT id) AS entities, max(outbox_sequence) AS highest, coalesce(sum(CASE event_type WHEN 'none such' THEN 1 END), 0)::BIGINT AS nothing FROM ev",
    "history_unpivot": f"WITH {PROJECTION}, {_at_time('h', CUTOFF)} SELECT * FROM h",
    "reconcile_as_of": f"""WITH {PROJECTION}, {_at_time('h', LATER)}, b AS (SELECT journal_id, account_id, currency, layer, sum(debit_units)::{DEC} AS dr_balance, sum(credit_units)::{DEC} AS cr_balance FROM entries WHERE recorded_at <= TIMESTAMP '{CUTOFF}' GROUP BY ALL) {_reconcile('h', 'b')}""",
    "except_equality": f"""WITH {PROJECTION}, a AS (SELECT journal_id, account_id, currency, layer, dr_balance, cr_balance FROM balances), b AS (SELECT * FROM persisted WHERE layer = 'settled')
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "fk_orphans": "SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey",
    "unique_combination": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "accepted_values": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY ALL",
    "non_negative": f"SELECT c_custkey, c_acctbal::DECIMAL(18,2)::{DEC} AS c_acctbal FROM customer WHERE c_acctbal < 0",
    "midpoint_quantile": "SELECT event_type, trunc(quantile_cont(epoch_us(ts)::DOUBLE, 0.5))::BIGINT AS midpoint_us FROM events GROUP BY event_type",
    "top_balances": f"SELECT o_orderkey, o_custkey, o_totalprice::DECIMAL(18,2)::{DEC} AS total FROM orders ORDER BY total DESC, o_orderkey LIMIT 100",
}
