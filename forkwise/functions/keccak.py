"""Keccak-256 of many messages at once, in numpy."""

from __future__ import annotations

import numpy as np

RATE = 136
_U = np.uint64


def _rotations() -> list[int]:
    """Offsets of the rho step, by lane x + 5 y."""
    out, x, y = [0] * 25, 1, 0
    for t in range(24):
        out[x + 5 * y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


def _round_constants() -> list[int]:
    """Constants of the iota step, from its shift register."""
    out, r = [], 1
    for _ in range(24):
        value = 0
        for j in range(7):
            if r & 1:
                value ^= 1 << ((1 << j) - 1)
            r = (r << 1) ^ (0x171 if r & 0x80 else 0)
        out.append(value)
    return out


ROTATIONS = np.array(_rotations(), np.uint64)
CONSTANTS = [_U(c) for c in _round_constants()]
#: Where the pi step puts each lane.
MOVES = np.array([(lane // 5) + 5 * ((2 * (lane % 5) + 3 * (lane // 5)) % 5) for lane in range(25)])


#: Messages that are hashed together: their lanes stay in a core's cache.
TOGETHER = 512
_LEFT = ROTATIONS.reshape(5, 5, 1)
_RIGHT = (_U(64) - _LEFT) & _U(63)


def permuted(state: np.ndarray) -> np.ndarray:
    """The permutation, of each column of ``state`` (25, n)."""
    n = state.shape[1]
    s = state.copy().reshape(5, 5, n)  # y, x
    left, right = np.empty_like(s), np.empty_like(s)
    column, turned = np.empty((7, n), np.uint64), np.empty((5, n), np.uint64)
    b = np.empty((5, 7, n), np.uint64)  # the first two of a row once more at its end
    lanes = [(left[i // 5, i % 5], right[i // 5, i % 5], b[MOVES[i] // 5, MOVES[i] % 5]) for i in range(25)]
    for constant in CONSTANTS:
        np.bitwise_xor.reduce(s, axis=0, out=column[1:6])
        column[0], column[6] = column[5], column[1]
        np.left_shift(column[2:], _U(1), out=turned)
        turned |= column[2:] >> _U(63)
        turned ^= column[:5]
        s ^= turned
        np.left_shift(s, _LEFT, out=left)
        np.right_shift(s, _RIGHT, out=right)
        for x, y, to in lanes:
            np.bitwise_or(x, y, out=to)
        b[:, 5:] = b[:, :2]
        np.invert(b[:, 1:6], out=s)
        s &= b[:, 2:]
        s ^= b[:, :5]
        s[0, 0] ^= constant
    return s.reshape(25, n)


#: What follows a message whose last block has so many bytes left.
_PADS = [b"", b"\x81", *(b"\x01" + bytes(k - 2) + b"\x80" for k in range(2, RATE + 1))]


def keccak256_many(messages: list[bytes]) -> list[bytes]:
    """Digest of each message; those of like length go together."""
    out: list[bytes] = [b""] * len(messages)
    by_blocks: dict[int, list[int]] = {}
    for i, m in enumerate(messages):
        by_blocks.setdefault(len(m) // RATE + 1, []).append(i)
    for blocks, all_members in by_blocks.items():
        for first in range(0, len(all_members), TOGETHER):
            members = all_members[first : first + TOGETHER]
            padded = b"".join([messages[i] + _PADS[blocks * RATE - len(messages[i])] for i in members])
            lanes = np.frombuffer(padded, "<u8").reshape(len(members), blocks, RATE // 8)
            state = np.zeros((25, len(members)), np.uint64)
            for b in range(blocks):
                state[: RATE // 8] ^= lanes[:, b].T
                state = permuted(state)
            digests = np.ascontiguousarray(state[:4].T).astype("<u8").tobytes()
            for row, i in enumerate(members):
                out[i] = digests[32 * row : 32 * row + 32]
    return out


def keccak256(message: bytes) -> bytes:
    return keccak256_many([message])[0]
