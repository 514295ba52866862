"""Address checksums as pandas UDFs; callers apply them to distinct candidate strings only."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def base58_parts(text: str) -> tuple[bool, int, int]:
    """(checksum ok, version byte, decoded length)."""
    number = 0
    for ch in text:
        digit = BASE58.find(ch)
        if digit < 0:
            return False, -1, 0
        number = number * 58 + digit
    zeros = len(text) - len(text.lstrip("1"))
    raw = bytes(zeros) + number.to_bytes((number.bit_length() + 7) // 8, "big")
    if len(raw) < 5:
        return False, -1, len(raw)
    check = hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4]
    return check == raw[-4:], raw[0], len(raw)


BASE58_PARTS = T.StructType([
    T.StructField("ok", T.BooleanType()), T.StructField("version", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
])


@F.pandas_udf(BASE58_PARTS)
def base58(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([base58_parts(v or "") for v in values], columns=["ok", "version", "size"])


def bech32_valid(address: str) -> bool:
    """BIP-173 / BIP-350 checksum of a lower-case address."""
    prefix, mark, data = address.rpartition("1")
    if not mark or not prefix or len(data) < 6 or any(c not in BECH32 for c in data):
        return False
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [BECH32.index(c) for c in data]
    state = 1
    for v in values:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ v
        for bit, generator in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            if top >> bit & 1:
                state ^= generator
    return state in (1, 0x2BC830A3)


@F.pandas_udf(T.BooleanType())
def bech32(values: pd.Series) -> pd.Series:
    return values.map(lambda v: bech32_valid(v or ""))


def _round_constants() -> list[int]:
    """Iota constants of Keccak-f[1600] from its degree-8 LFSR."""
    out, state = [], 1
    for _ in range(24):
        word = 0
        for j in range(7):
            if state & 1:
                word |= 1 << ((1 << j) - 1)
            state = state << 1 ^ (0x171 if state & 0x80 else 0)
        out.append(word)
    return out


def _rotations() -> dict[tuple[int, int], int]:
    x, y, out = 1, 0, {(0, 0): 0}
    for t in range(24):
        out[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    return out


def keccak256_block(messages: np.ndarray) -> np.ndarray:
    """Keccak-256 of many equal-length messages shorter than one block; (n, length) bytes in, (n, 32) bytes out."""
    n, length = messages.shape
    block = np.zeros((n, 136), dtype=np.uint8)
    block[:, :length] = messages
    block[:, length] ^= 0x01
    block[:, 135] ^= 0x80
    lanes = {(x, y): np.zeros(n, dtype=np.uint64) for x in range(5) for y in range(5)}
    words = block.view("<u8")
    for i in range(17):
        lanes[i % 5, i // 5] = words[:, i].astype(np.uint64)
    turns = _rotations()

    def rotate(a: np.ndarray, by: int) -> np.ndarray:
        return a if by == 0 else (a << np.uint64(by)) | (a >> np.uint64(64 - by))

    for constant in _round_constants():
        parity = [np.bitwise_xor.reduce([lanes[x, y] for y in range(5)]) for x in range(5)]
        mixed = {
            (x, y): lanes[x, y] ^ parity[x - 1] ^ rotate(parity[(x + 1) % 5], 1) for x in range(5) for y in range(5)
        }
        moved = {(y, (2 * x + 3 * y) % 5): rotate(v, turns[x, y]) for (x, y), v in mixed.items()}
        lanes = {
            (x, y): moved[x, y] ^ (~moved[(x + 1) % 5, y] & moved[(x + 2) % 5, y]) for x in range(5) for y in range(5)
        }
        lanes[0, 0] = lanes[0, 0] ^ np.uint64(constant)
    return np.stack([lanes[x, 0] for x in range(4)], axis=1).astype("<u8").view(np.uint8)


def eip55_forms(lower: pd.Series) -> pd.Series:
    """EIP-55 spelling of lower-case 0x addresses; others pass through as NULL."""
    good = lower.map(lambda a: bool(a) and re.fullmatch("0x[0-9a-f]{40}", a) is not None).astype(bool)
    out = pd.Series([None] * len(lower), index=lower.index, dtype=object)
    if good.any():
        body = lower[good].str[2:]
        chars = np.array([list(b.encode()) for b in body], dtype=np.uint8)
        digest = keccak256_block(chars)
        nibbles = np.stack([digest >> 4, digest & 15], axis=2).reshape(len(chars), 64)[:, :40]
        upper = (nibbles >= 8) & (chars >= ord("a"))
        spelled = np.where(upper, chars - 32, chars).astype(np.uint8)
        out[good] = ["0x" + row.tobytes().decode() for row in spelled]
    return out


@F.pandas_udf(T.StringType())
def eip55(lower: pd.Series) -> pd.Series:
    return eip55_forms(lower)
