"""Builders of notification logs for tests."""

from __future__ import annotations

from forkwise.functions.scalars import ZERO_HASH


def block_hash(n: int, fork: int = 0) -> str:
    return f"0x{n:016x}{fork:02x}" + "0" * 46


def addr(n: int) -> str:
    return f"0x{n:040x}"


def tx(n: int) -> str:
    return f"0x{n:064x}"


def account(balance: int | None):
    return None if balance is None else {"balance": str(balance), "nonce": 0, "code_hash": ZERO_HASH}


def change(n: int, old: int | None, new: int | None, storage=()):
    return {"address": addr(n), "old": account(old), "new": account(new), "storage": [{"slot": s, "old_value": a, "new_value": b} for s, a, b in storage]}


def receipt(n: int, status: bool = True, gas: int = 21000):
    return {"tx_hash": tx(n), "status": status, "cumulative_gas_used": gas}


def block(n: int, fork: int = 0, changes=(), receipts=()):
    return {"block_number": n, "block_hash": block_hash(n, fork), "parent_hash": block_hash(n - 1, fork), "changes": list(changes), "receipts": list(receipts)}


def plain(n: int, fork: int = 0):
    k = n + 10 * fork
    return block(n, fork, [change(k, 1000, 900)], [receipt(k)])


def log(*items):
    """Rows of (kind, old blocks, new blocks) notifications, numbered from 1. A segment that a kind must have is not empty."""
    for kind, old, new in items:
        if kind != "commit" and not old or kind != "revert" and not new:
            raise ValueError(f"a {kind} without blocks")
    return [{"seq": seq, "kind": kind, "side": side, **b} for seq, (kind, old, new) in enumerate(items, 1) for side, blocks in (("old", old), ("new", new)) for b in blocks]
