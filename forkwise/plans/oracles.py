"""SQL of the registered chain queries, for DuckDB over the driver's tables."""

from __future__ import annotations

from ..sources import projection as P
from . import queries as Q


def _hash(n: str, fork: str) -> str:
    return f"'0x' || lower(lpad(to_hex(({n})::BIGINT), 16, '0')) || lower(lpad(to_hex(({fork})::BIGINT), 2, '0')) || repeat('0', 46)"


_TOP = f"(SELECT 1 + max(o_orderkey) // {P.ORDERS_IN_BLOCK} FROM orders)"
_HEIGHTS = f"(SELECT unnest(range(1::BIGINT, {_TOP} + 1)) AS n) AS t"
ZERO = f"'{'0x' + '0' * 64}'"

BL = f"""wn AS (SELECT o_orderkey // {P.ORDERS_IN_BLOCK} // 10 AS pair, count(*) FILTER (o_orderstatus = 'F') > count(*) FILTER (o_orderstatus = 'O') AS back
    FROM orders WHERE (1 + o_orderkey // {P.ORDERS_IN_BLOCK}) % 10 IN (8, 9) GROUP BY ALL),
  bf AS (SELECT n, f AS fork, coalesce(back, false) AS back FROM {_HEIGHTS} JOIN (VALUES (0), (1)) AS x(f) ON f = 0 OR n % 10 IN (8, 9) LEFT JOIN wn ON pair = (n - 1) // 10),
  bl AS (SELECT n, fork, back, CASE WHEN n % 10 IN (8, 9) AND (fork = 1) = back THEN 'reorged' ELSE 'active' END AS st FROM bf)"""

CB = f"""{BL}, cb AS (SELECT n AS block_number, {_hash('n', 'fork')} AS block_hash,
    {_hash('n - 1', 'CASE WHEN n % 10 = 9 THEN fork WHEN n % 10 = 0 AND NOT back THEN 1 ELSE 0 END')} AS parent_hash,
    st AS canonical_status, CASE WHEN n % 32 = 0 THEN true END AS finalized_hint, NULL::BIGINT AS derived_checkpoint_id, fork FROM bl)"""

_OWN_BRANCH = """((x.st = 'active' AND p.st = 'active') OR (x.st = 'reorged' AND
    ((p.st = 'active' AND p.n < x.n - (x.n % 10 - 8)) OR (p.st = 'reorged' AND p.n >= x.n - (x.n % 10 - 8)))))"""

AD = f"""ev AS (SELECT 1 + event_id % {_TOP} AS n, user_id, event_type, cast(round(value * 100) AS BIGINT) AS cents FROM events),
  d AS (SELECT b.n, b.fork, b.st, e.user_id, sum(e.cents)::BIGINT AS delta FROM bl b JOIN ev e ON e.n = b.n
    WHERE b.n % 10 NOT IN (8, 9) OR (b.fork = 0 AND e.event_type <> 'signup') OR (b.fork = 1 AND e.event_type <> 'error') GROUP BY ALL),
  av AS (SELECT x.n, x.fork, x.user_id, max(x.delta) AS delta, sum(p.delta)::BIGINT AS old FROM d x LEFT JOIN d p ON p.user_id = x.user_id AND p.n < x.n AND {_OWN_BRANCH} GROUP BY ALL),
  ad AS (SELECT n AS block_number, {_hash('n', 'fork')} AS block_hash, '0x' || lower(lpad(to_hex(user_id), 40, '0')) AS address,
    old::VARCHAR AS old_balance, (coalesce(old, 0) + delta)::VARCHAR AS new_balance, CASE WHEN old IS NOT NULL THEN 0 END AS old_nonce, 0 AS new_nonce,
    CASE WHEN old IS NOT NULL THEN {ZERO} END AS old_code_hash, {ZERO} AS new_code_hash,
    CASE WHEN old IS NULL THEN 'created' WHEN delta = 0 THEN 'touched' ELSE 'modified' END AS change_kind FROM av)"""

RC = f"""od AS (SELECT 1 + o_orderkey // {P.ORDERS_IN_BLOCK} AS n, o_orderkey, o_orderstatus, 21000 + cast(round(o_totalprice * 100) AS BIGINT) % 100000 AS gas FROM orders),
  ro AS (SELECT b.n, b.fork, o_orderkey, o_orderstatus, gas FROM bl b JOIN od ON od.n = b.n
    WHERE b.n % 10 NOT IN (8, 9) OR (b.fork = 0 AND o_orderstatus <> 'P') OR (b.fork = 1 AND o_orderstatus <> 'F')),
  rw AS (SELECT n AS block_number, {_hash('n', 'fork')} AS block_hash, (row_number() OVER w - 1)::INT AS tx_index, '0x' || lower(lpad(to_hex(o_orderkey), 64, '0')) AS tx_hash,
    o_orderstatus <> 'F' AS status, (sum(gas) OVER w)::BIGINT AS cumulative_gas_used FROM ro
    WINDOW w AS (PARTITION BY n, fork ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  rx AS (SELECT *, lower(to_hex(cumulative_gas_used)) AS hx FROM rw),
  ry AS (SELECT *, CASE WHEN length(hx) % 2 = 1 THEN '0' || hx ELSE hx END AS he FROM rx),
  rz AS (SELECT *, CASE WHEN status THEN '01' ELSE '80' END || lower(to_hex((128 + length(he) / 2)::BIGINT)) || he || 'b90100' || repeat('00', 256) || 'c0' AS body FROM ry),
  rc AS (SELECT block_number, block_hash, tx_index, tx_hash, tx_index AS receipt_index, 'f9' || lower(lpad(to_hex((length(body) / 2)::BIGINT), 4, '0')) || body AS receipt_rlp,
    '0x' || sha256(block_hash) AS receipt_root_anchor, status, cumulative_gas_used FROM rz)"""

SD = f"""sw AS (SELECT b.n, b.fork, b.st, l_suppkey AS a, l_partkey % 16 AS s, cast(max(l_quantity) AS BIGINT) AS v FROM bl b JOIN lineitem ON 1 + l_orderkey // {P.ORDERS_IN_BLOCK} = b.n
    WHERE b.n % 10 NOT IN (8, 9) OR (b.fork = 0 AND l_returnflag <> 'R') OR (b.fork = 1 AND l_returnflag <> 'A') GROUP BY ALL),
  sj AS (SELECT x.n, x.fork, x.a, x.s, max(x.v) AS v, coalesce(arg_max(p.v, p.n), 0) AS o FROM sw x LEFT JOIN sw p ON p.a = x.a AND p.s = x.s AND p.n < x.n AND {_OWN_BRANCH} GROUP BY ALL),
  sa AS (SELECT n AS block_number, {_hash('n', 'fork')} AS block_hash, '0x' || lower(lpad(to_hex(a), 40, '0')) AS address, s::VARCHAR AS slot, o::VARCHAR AS old_value, v::VARCHAR AS new_value FROM sj),
  sd AS (SELECT * FROM sa WHERE old_value <> new_value)"""

LG = """lg AS (SELECT 3 * (n // 10) AS seq, 'new' AS side, n FROM bl WHERE fork = 0
    UNION ALL SELECT 3 * (n // 10) + 1, CASE WHEN fork = 0 THEN 'old' ELSE 'new' END, n FROM bl WHERE n % 10 >= 8
    UNION ALL SELECT 3 * (n // 10) + 2, CASE WHEN fork = 1 THEN 'old' ELSE 'new' END, n FROM bl WHERE n % 10 >= 8 AND back),
  st AS (SELECT seq, 0 AS step, min(n) - 1 AS b FROM lg WHERE side = 'old' GROUP BY seq UNION ALL SELECT seq, 1, n FROM lg WHERE side = 'new' UNION ALL SELECT seq, 2, max(n) FROM lg WHERE side = 'new' GROUP BY seq),
  sg AS (SELECT *, sum((step = 0)::INT) OVER w AS r, sum((step = 2)::INT) OVER w AS f FROM st WINDOW w AS (ORDER BY seq, step, b ROWS UNBOUNDED PRECEDING)),
  tl AS (SELECT seq, step, CASE step WHEN 0 THEN 'rollback' WHEN 1 THEN 'commit' ELSE 'finish' END AS operation, b AS block_number,
    max(CASE WHEN step <> 2 THEN b END) OVER (PARTITION BY r ORDER BY seq, step, b ROWS UNBOUNDED PRECEDING) AS streaming,
    CASE WHEN f = 0 THEN 0 ELSE min(CASE WHEN step <> 1 THEN b END) OVER (PARTITION BY f ORDER BY seq, step, b ROWS UNBOUNDED PRECEDING) END AS finished_height FROM sg)"""

OPS = """op AS (SELECT block_number, block_hash, 0 AS phase, address, 0 AS part, '' AS slot, 0 AS tx, 'account_diffs' AS table_name, '{"block_hash":"' || block_hash || '","address":"' || address || '"}' AS primary_key_ref FROM ad
    UNION ALL SELECT block_number, block_hash, 0, address, 1, slot, 0, 'storage_diffs', '{"block_hash":"' || block_hash || '","address":"' || address || '","slot":"' || slot || '"}' FROM sd
    UNION ALL SELECT block_number, block_hash, 1, '', 2, '', tx_index, 'receipt_artifacts', '{"block_hash":"' || block_hash || '","tx_index":' || tx_index || '}' FROM rc),
  ops AS (SELECT block_number AS reorg_target_block, block_hash, row_number() OVER (PARTITION BY block_hash ORDER BY phase, address, part, slot, tx) - 1 AS op_sequence, table_name, primary_key_ref, '' AS inverse_payload FROM op)"""

ALL = f"WITH {CB}, {AD}, {SD}, {RC}"
_BLOCK = "block_number, block_hash, parent_hash, canonical_status, finalized_hint, derived_checkpoint_id"
_LIVE = "block_hash IN (SELECT block_hash FROM cb WHERE canonical_status = 'active')"
_SUMMARY = """SELECT c.block_number, c.block_hash, (SELECT count(*) FROM ad WHERE ad.block_hash = c.block_hash) AS account_diffs,
    (SELECT count(*) FROM sd WHERE sd.block_hash = c.block_hash) AS storage_diffs, (SELECT count(*) FROM rc WHERE rc.block_hash = c.block_hash) AS receipts"""
_ADDRESS_INDEX = f"SELECT address, block_number, block_hash, change_kind FROM ad WHERE {_LIVE}"
_SLOT_INDEX = f"SELECT address, slot, block_number, block_hash FROM sd WHERE {_LIVE}"
_LAST = "SELECT streaming, streaming - {behind} AS durable, 0 AS compacted_until, 0 AS proof_indexed_until, streaming AS canonical_tip, finished_height FROM tl WHERE step <> 2 ORDER BY seq DESC, step DESC, block_number DESC LIMIT 1"
_STATUS = "SELECT block_number, block_hash, parent_hash, canonical_status FROM cb"
_DAMAGED = "block_number % 97 = 0"
_BATCH = "block_number > 100 AND block_number <= 600"
_OUT_OF_ORDER = "streaming % 50 = 0 OR streaming % 64 = 0"

ORACLES: dict[str, str] = {
    "block_by_hash": f"WITH {CB} SELECT {_BLOCK} FROM cb WHERE block_hash = '{Q.fork_hash(Q.HEIGHT, 0)}'",
    "active_blocks_above": f"WITH {CB} SELECT {_BLOCK} FROM cb WHERE block_number > 600 AND canonical_status = 'active'",
    "account_diffs_for_block": f"WITH {BL}, {AD} SELECT * FROM ad WHERE block_hash = '{Q.fork_hash(Q.HEIGHT, 1)}'",
    "storage_diffs_for_block": f"WITH {BL}, {SD} SELECT * FROM sd WHERE block_hash = '{Q.fork_hash(Q.HEIGHT, 0)}'",
    "receipts_for_block": f"WITH {BL}, {RC} SELECT * FROM rc WHERE block_hash = '{Q.fork_hash(Q.HEIGHT, 1)}'",
    "revert_ops_for_block": f"{ALL}, {OPS} SELECT * FROM ops WHERE block_hash = '{Q.fork_hash(Q.HEIGHT, 0)}'",
    "hash_at_height": f"WITH {CB} SELECT n AS block_number, block_hash FROM unnest(range(721, 761)) AS h(n) LEFT JOIN (SELECT * FROM cb WHERE canonical_status = 'active') c ON c.block_number = n",
    "block_is_canonical": f"WITH {BL} SELECT t.n AS block_number, {_hash('t.n', 'f')} AS block_hash, coalesce(st = 'active', false) AS is_canonical FROM {_HEIGHTS} CROSS JOIN (VALUES (0), (1)) AS x(f) LEFT JOIN bl ON bl.n = t.n AND fork = f",
    "account_diff_range": f"WITH {CB}, {AD} SELECT * FROM ad WHERE {_LIVE} AND address = '{Q.address(Q.USER)}' AND block_number BETWEEN {Q.LOW} AND {Q.HIGH}",
    "account_history": f"WITH {CB}, {AD} SELECT * FROM ad WHERE {_LIVE}",
    "storage_diff_range": f"WITH {CB}, {SD} SELECT * FROM sd WHERE {_LIVE} AND address = '{Q.address(Q.SUPPLIER)}' AND slot = '{Q.SLOT}' AND block_number BETWEEN {Q.LOW} AND {Q.HIGH}",
    "storage_history": f"WITH {CB}, {SD} SELECT * FROM sd WHERE {_LIVE}",
    "receipt_by_tx_hash": f"WITH {CB}, {RC} SELECT * FROM rc WHERE {_LIVE} AND tx_hash = '{Q.tx_hash(Q.ORDER)}' ORDER BY block_number DESC, tx_index LIMIT 1",
    "canonical_receipts": f"WITH {CB}, {RC} SELECT * FROM rc WHERE {_LIVE}",
    "active_block_count": f"WITH {CB} SELECT count(*) AS active_blocks FROM cb WHERE canonical_status = 'active'",
    "canonical_tip": f"WITH {CB} SELECT coalesce(max(block_number), 0) AS canonical_tip FROM cb WHERE canonical_status = 'active'",
    "canonical_head": f"WITH {CB} SELECT block_number, block_hash FROM cb WHERE canonical_status = 'active' ORDER BY block_number DESC LIMIT 1",
    "finalized_height": f"WITH {CB} SELECT max(block_number) AS finalized_height FROM cb WHERE canonical_status = 'active' AND finalized_hint",
    "receipt_block_roots": f"WITH {BL}, {RC} SELECT DISTINCT block_number, block_hash, receipt_root_anchor FROM rc",
    "block_diff_summary": f"{ALL} {_SUMMARY} FROM cb c",
    "change_kind_matrix": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'created' WHEN o_orderkey % 5 = 0 THEN 'destroyed'
        WHEN o_custkey % 4 <> o_custkey % 3 OR o_orderkey % 2 <> o_custkey % 2 THEN 'modified' ELSE 'touched' END AS change_kind FROM orders WHERE o_orderkey % 15 <> 0""",
    "storage_noop_filter": f"WITH {BL}, {SD} SELECT address, count(*) AS writes, count(*) FILTER (old_value <> new_value) AS changes FROM sa GROUP BY address",
    "reorg_base": f"WITH {BL}, {LG} SELECT seq, min(n) - 1 AS base, count(*) AS n_live FROM lg WHERE side = 'old' GROUP BY seq",
    "rlp_index_key": f"""WITH {BL}, {RC}, k AS (SELECT o_orderkey::BIGINT AS n FROM orders UNION SELECT receipt_index FROM rc), r AS (SELECT n, lower(to_hex(n)) AS h FROM k), e AS (SELECT n, CASE WHEN length(h) % 2 = 1 THEN '0' || h ELSE h END AS h FROM r)
        SELECT n AS receipt_index, CASE WHEN n = 0 THEN '80' WHEN n < 128 THEN h ELSE to_hex(128 + length(h) // 2) || h END AS rlp FROM e""",
    "fork_hashes": f"WITH {BL} SELECT n AS block_number, fork, {_hash('n', 'fork')} AS block_hash FROM bl",
    "extract_account_diffs": f"WITH {BL}, {AD} SELECT * FROM ad",
    "extract_storage_diffs": f"WITH {BL}, {SD} SELECT * FROM sd",
    "extract_receipts": f"WITH {BL}, {RC} SELECT * FROM rc",
    "revert_ops": f"{ALL}, {OPS} SELECT * FROM ops",
    "segment_net_change": f"""WITH {CB}, {AD}, x AS (SELECT address, arg_min(coalesce(old_balance, ''), block_number) AS o, arg_max(new_balance, block_number) AS n FROM ad WHERE {_LIVE} AND block_number BETWEEN 101 AND 200 GROUP BY address)
        SELECT address, nullif(o, '') AS old_balance, n AS new_balance, CASE WHEN o = '' THEN 'created' WHEN o <> n THEN 'modified' ELSE 'touched' END AS change_kind FROM x""",
    "canonical_status_after_log": f"WITH {CB} {_STATUS}",
    "commit_fold": f"{ALL}, {OPS} {_SUMMARY}, (SELECT count(*) FROM ops WHERE ops.block_hash = c.block_hash) AS undo_ops, canonical_status FROM cb c",
    "apply_revert": f"""{ALL} SELECT 'account_diffs' AS table_name, block_number, block_hash, count(*) AS n_rows FROM ad WHERE {_LIVE} GROUP BY ALL
        UNION ALL SELECT 'storage_diffs', block_number, block_hash, count(*) FROM sd WHERE {_LIVE} GROUP BY ALL UNION ALL SELECT 'receipt_artifacts', block_number, block_hash, count(*) FROM rc WHERE {_LIVE} GROUP BY ALL
        UNION ALL SELECT 'canonical_blocks', block_number, block_hash, 1 FROM cb WHERE {_LIVE}""",
    "duplicate_commit": f"WITH {BL}, {AD} SELECT * FROM ad",
    "phantom_revert": f"WITH {CB} {_STATUS}",
    "cursor_timeline": f"WITH {BL}, {LG} SELECT seq, step, operation, block_number, streaming, streaming AS durable, streaming AS canonical_tip, finished_height FROM tl",
    "latest_checkpoint": f"WITH {BL}, {LG} {_LAST.format(behind=0)}",
    "cursor_on_restart": f"WITH {BL}, {LG} SELECT * REPLACE (durable AS streaming) FROM ({_LAST.format(behind=3)})",
    "merged_cursors": f"WITH {BL}, {LG} SELECT * REPLACE (least(durable, 2 * {_TOP} // 3) AS compacted_until, least(durable, 2 * {_TOP} // 3) AS proof_indexed_until), true AS consistent FROM ({_LAST.format(behind=0)})",
    "inv_checkpoint_consistent": f"WITH {BL}, {LG} SELECT count(*) AS checkpoints, count(*) FILTER ({_OUT_OF_ORDER}) AS violations FROM tl WHERE step <> 2",
    "address_block_index": f"WITH {CB}, {AD} {_ADDRESS_INDEX}",
    "slot_block_index": f"WITH {CB}, {SD} {_SLOT_INDEX}",
    "compaction_batch": f"WITH {CB}, {AD}, {SD} SELECT address, NULL::VARCHAR AS slot, block_number, block_hash FROM ({_ADDRESS_INDEX}) WHERE {_BATCH} UNION ALL SELECT * FROM ({_SLOT_INDEX}) WHERE {_BATCH}",
    "compaction_gaps": f"SELECT n AS block_number FROM {_HEIGHTS} WHERE n % 97 = 0 AND n > 100 AND n <= 600",
    "index_append": f"WITH {CB}, {AD} {_ADDRESS_INDEX} AND block_number > 300",
    "cursor_unwind": f"""WITH {BL}, {LG} SELECT seq * 4294967296 + step * 2147483648 + block_number AS id, least(streaming - 3, 2 * {_TOP} // 3) AS compacted_until,
        least(streaming - 5, 2 * {_TOP} // 3) AS proof_indexed_until FROM tl WHERE step <> 2""",
    "segment_net_slots": f"""WITH {CB}, {SD}, x AS (SELECT address, slot, arg_min(old_value, block_number) AS old_value, arg_max(new_value, block_number) AS new_value FROM sa WHERE {_LIVE} AND block_number BETWEEN 101 AND 200 GROUP BY ALL)
        SELECT * FROM x WHERE old_value <> new_value""",
    "compaction_batches_plan": f"SELECT s AS after, least(s + 100, {_TOP}) AS up_to, s + 100 >= {_TOP} AS done FROM (SELECT unnest(range(0::BIGINT, {_TOP}, 100)) AS s)",
    "index_unwind": f"WITH {CB}, {AD}, {SD} SELECT address, NULL::VARCHAR AS slot, block_number, block_hash FROM ({_ADDRESS_INDEX}) WHERE block_number <= 355 UNION ALL SELECT * FROM ({_SLOT_INDEX}) WHERE block_number <= 355",
    "inv_orphan_account": f"WITH {BL}, {AD} SELECT count(*) AS violations FROM ad WHERE {_DAMAGED}",
    "inv_orphan_storage": f"WITH {BL}, {SD} SELECT count(*) AS violations FROM sd WHERE {_DAMAGED}",
    "inv_orphan_receipts": f"WITH {BL}, {RC} SELECT count(*) AS violations FROM rc WHERE {_DAMAGED}",
    "inv_block_invisible": f"""WITH {CB}, {AD} SELECT 'stored' AS what, count(*) AS n_rows FROM ad WHERE NOT {_LIVE} UNION ALL SELECT 'visible', 0
        UNION ALL SELECT 'visible to a stale table', count(*) FROM ad WHERE NOT {_LIVE} AND block_number % 7 = 0""",
    "inv_index_parity": f"""WITH {CB}, {AD}, x AS (SELECT CASE WHEN {_LIVE} THEN 'diff_only' ELSE 'index_only' END AS side, block_number FROM ad)
        SELECT side, count(*) AS n_rows FROM x WHERE (side = 'diff_only') = (block_number > 700) GROUP BY side""",
    "invariant_report": f"""{ALL}, {LG} SELECT 'orphan_account_diffs' AS check, count(*) AS violations FROM ad WHERE {_DAMAGED} UNION ALL SELECT 'orphan_storage_diffs', count(*) FROM sd WHERE {_DAMAGED}
        UNION ALL SELECT 'orphan_receipts', count(*) FROM rc WHERE {_DAMAGED} UNION ALL SELECT 'checkpoints', count(*) FILTER ({_OUT_OF_ORDER}) FROM tl WHERE step <> 2
        UNION ALL SELECT 'address_index', count(*) FROM ad WHERE {_LIVE} AND block_number > 700""",
    "canonical_anchor": f"""WITH {CB}, live AS (SELECT * FROM cb WHERE canonical_status = 'active') SELECT block_number, block_hash, canonical_status = 'active' AS is_canonical,
        (SELECT max(block_number) FROM live) AS head_number, (SELECT arg_max(block_hash, block_number) FROM live) AS head_hash, (SELECT max(block_number) FROM live WHERE finalized_hint) AS finalized_height FROM cb""",
    "stored_status": f"WITH {CB} {_STATUS}",
    "stored_account_history": f"WITH {CB}, {AD} SELECT * FROM ad WHERE {_LIVE}",
    "stored_index": f"WITH {CB}, {AD} {_ADDRESS_INDEX}",
    "stored_losing_rows": f"""WITH {CB}, {AD}, {RC} SELECT 'account_diffs' AS table_name, block_number, block_hash, count(*) AS n_rows FROM ad WHERE NOT {_LIVE} GROUP BY ALL
        UNION ALL SELECT 'receipt_artifacts', block_number, block_hash, count(*) FROM rc WHERE NOT {_LIVE} GROUP BY ALL""",
    "stored_cursors": f"WITH {BL}, {LG} SELECT * REPLACE (durable AS compacted_until, (SELECT arg_max(finished_height, (seq, step, block_number)) FROM tl) AS finished_height) FROM ({_LAST.format(behind=0)})",
}
