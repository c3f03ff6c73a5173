"""Hashing, tries and proofs against public constants and round trips."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forkwise.functions import trie
from forkwise.functions.keccak import keccak256, keccak256_many


def test_public_constants():
    assert keccak256(b"").hex() == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    assert keccak256(b"\x80").hex() == "56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421"


@given(st.lists(st.binary(max_size=400), max_size=12))
@settings(max_examples=20, deadline=None)
def test_batch_equals_single(messages):
    assert keccak256_many(messages) == [keccak256(m) for m in messages]


def test_index_keys():
    assert [trie.index_key(i) for i in (0, 1, 127, 128, 256)] == ["80", "01", "7f", "8180", "820100"]


@pytest.mark.parametrize("n", [1, 2, 16, 127, 128, 129, 300])
def test_prove_and_verify(n):
    receipts = [bytes([i % 251]) * (1 + i % 40) for i in range(n)]
    root = trie.tries([receipts])[0]
    for i in {0, n // 2, n - 1}:
        nodes = trie.proof(root, i)
        assert trie.verify(root.hash, i, receipts[i], nodes)
        assert not trie.verify(root.hash, i, receipts[i] + b"x", nodes)
        assert not trie.verify(bytes(32), i, receipts[i], nodes)
        assert not trie.verify(root.hash, i + 1, receipts[i], nodes)
        assert not trie.verify(root.hash, i, receipts[i], nodes[:-1])
        assert not trie.verify(root.hash, i, receipts[i], [*nodes[:-1], nodes[-1][:-1] + b"\xff"])
    with pytest.raises(IndexError):
        trie.proof(root, n)


def test_no_receipts():
    with pytest.raises(ValueError):
        trie.tries([[]])


def test_public_root():
    """The receipts root in the header of a public block with one receipt, Ethereum's 46147."""
    root, gas = bytes.fromhex("96a8e009d2b88b1483e6941e6812e32263b05683fac202abc622a3e31aed1957"), (21000).to_bytes(2, "big")
    receipt = trie.rlp_items([trie.rlp_bytes(root), trie.rlp_bytes(gas), trie.rlp_bytes(bytes(256)), b"\xc0"])
    found = trie.tries([[receipt]])[0]
    assert found.hash.hex() == "fe2bf2a941abf41d72637e5b91750332a30283efd40c424dc522b77e6f0ed8c4"
    assert trie.verify(found.hash, 0, receipt, trie.proof(found, 0))


def plain_root(receipts):
    """Root hash by the definition, one key and node at a time."""

    def rlp(x):
        if isinstance(x, bytes):
            if len(x) == 1 and x[0] < 128:
                return x
            body, base = x, 128
        else:
            body, base = b"".join(map(rlp, x)), 192
        if len(body) < 56:
            return bytes([base + len(body)]) + body
        n = len(body).to_bytes((len(body).bit_length() + 7) // 8, "big")
        return bytes([base + 55 + len(n)]) + n + body

    def packed(nibbles, end):
        flags = [2 * end + 1] if len(nibbles) % 2 else [2 * end, 0]
        nibbles = [*flags, *nibbles]
        return bytes(16 * a + b for a, b in zip(nibbles[::2], nibbles[1::2]))

    def node(pairs):
        """The structure of the trie over (nibbles, value) pairs."""
        if not pairs:
            return b""
        if len(pairs) == 1:
            return [packed(pairs[0][0], 1), pairs[0][1]]
        n = 0
        while all(len(k) > n and k[n] == pairs[0][0][n] for k, _ in pairs):
            n += 1
        if n:
            return [packed(pairs[0][0][:n], 0), named([(k[n:], v) for k, v in pairs])]
        ways = [named([(k[1:], v) for k, v in pairs if k[:1] == [i]]) for i in range(16)]
        return [*ways, b"".join(v for k, v in pairs if not k)]

    def named(pairs):
        own = node(pairs)
        return own if len(rlp(own)) < 32 else keccak256(rlp(own))

    keys = [rlp(b"" if i == 0 else i.to_bytes((i.bit_length() + 7) // 8, "big")) for i in range(len(receipts))]
    return keccak256(rlp(node([([h for b in k for h in (b >> 4, b & 15)], v) for k, v in zip(keys, receipts)])))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 15, 16, 17, 127, 128, 129, 256, 257, 300])
@pytest.mark.parametrize("size", [1, 40])
def test_roots_equal_the_definition(n, size):
    """Short receipts are embedded in their parents, longer ones are named by hash."""
    receipts = [bytes([i % 251]) * (1 + (size + i) % size) + bytes([i // 251]) for i in range(n)]
    assert trie.root_hash(receipts) == plain_root(receipts)


def test_few_blocks_are_worked_on_together():
    import pyarrow as pa

    from forkwise.operators import proofs

    batch = pa.RecordBatch.from_pydict({"n": list(range(10_000))})
    cut = list(proofs._slices(iter([batch]), proofs.BLOCKS))
    assert max(b.num_rows for b in cut) == proofs.BLOCKS
    assert [n for b in cut for n in b.column("n").to_pylist()] == list(range(10_000))


def test_a_shape_serves_all_blocks_of_its_size():
    a, b = trie.tries([[b"a" * 40] * 20, [b"b" * 300] * 20])
    assert a.shape is b.shape and a.hash != b.hash
