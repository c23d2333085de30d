"""CRC-32C of bytes, by numpy lanes."""

from __future__ import annotations

import numpy as np

#: The reflected Castagnoli polynomial.
POLYNOMIAL = 0x82F63B78
_LANE = 1024


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


TABLE = _table()
_LIST = TABLE.tolist()


def _past_zeros(n: int) -> list[list[int]]:
    """For each byte of a register what it becomes ``n`` zero bytes later."""
    out = []
    for byte in range(4):
        x = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for _ in range(n):
            x = (x >> np.uint32(8)) ^ TABLE[x & 0xFF]
        out.append(x.tolist())
    return out


_SKIP = _past_zeros(_LANE)


def crc32c(data: bytes, value: int = 0) -> int:
    """The checksum of ``data`` after bytes whose checksum is ``value``.

    Lanes of one length run side by side from register 0 and are joined: the
    register is linear, so that a lane adds to what zeros would make of it.
    """
    register = value ^ 0xFFFFFFFF
    lanes = len(data) // _LANE
    if lanes > 1:
        columns = np.frombuffer(data, np.uint8, lanes * _LANE).reshape(lanes, _LANE).T
        x = np.zeros(lanes, np.uint32)
        for column in np.ascontiguousarray(columns):
            x = (x >> np.uint32(8)) ^ TABLE[(x ^ column) & 0xFF]
        a, b, c, d = _SKIP
        for own in x.tolist():
            register = a[register & 0xFF] ^ b[register >> 8 & 0xFF] ^ c[register >> 16 & 0xFF] ^ d[register >> 24] ^ own
        data = data[lanes * _LANE :]
    for byte in data:
        register = register >> 8 ^ _LIST[(register ^ byte) & 0xFF]
    return register ^ 0xFFFFFFFF
