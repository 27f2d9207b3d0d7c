"""Deterministic content keys: a framed SHA-256 in which position, namespace, version, NULL and '' all count."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the key format: opening tag, and digits of a position or length.
OPENING, DIGITS = "SK1;", 20


def _framed(text: Column) -> Column:
    """A value behind its UTF-8 length; a NULL has a mark of its own."""
    size = F.lpad(F.octet_length(text).cast("string"), DIGITS, "0")
    return F.coalesce(F.concat(F.lit("V"), size, F.lit(":"), text, F.lit(";")), F.lit("N;"))


def _framed_value(text: str | None) -> str:
    return "N;" if text is None else f"V{len(text.encode()):0{DIGITS}d}:{text};"


def stable_sha256(namespace: str, version: str, *fields: Column | str) -> Column:
    """Lowercase hex key of the fields, each taken as text."""
    head = f"{OPENING}NS={_framed_value(namespace)}PV={_framed_value(version)}"
    parts = [F.lit(head)]
    for place, field in enumerate(fields, 1):
        column = F.col(field) if isinstance(field, str) else field
        parts += [F.lit(f"P{place:0{DIGITS}d}="), _framed(column.cast("string"))]
    return F.sha2(F.concat(*parts), 256)


def stable_sha256_of(namespace: str, version: str, values: Sequence[str | None]) -> str:
    """The same key for plain values."""
    body = "".join(f"P{k:0{DIGITS}d}={_framed_value(v)}" for k, v in enumerate(values, 1))
    head = f"{OPENING}NS={_framed_value(namespace)}PV={_framed_value(version)}"
    return hashlib.sha256((head + body).encode()).hexdigest()


def uuid_of(key: Column) -> Column:
    """A UUID's text from the first 32 hex digits of a key."""
    return F.concat_ws("-", *(F.substring(key, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def _crc_columns() -> list[int]:
    """For each bit of a CRC-32 of four bytes, what it tells of these bytes: that CRC, less the one of zeros, is linear and can be undone."""
    zero = zlib.crc32(bytes(4))
    rows = [(zlib.crc32((1 << k).to_bytes(4, "big")) ^ zero, 1 << k) for k in range(32)]
    for bit in range(32):
        at = next(k for k in range(bit, 32) if rows[k][0] >> bit & 1)
        rows[bit], rows[at] = rows[at], rows[bit]
        rows = [(a ^ rows[bit][0], b ^ rows[bit][1]) if k != bit and a >> bit & 1 else (a, b) for k, (a, b) in enumerate(rows)]
    return [b for _, b in rows]


def checksum(key: Column) -> Column:
    """Order-independent checksum of keys as an aggregate: XOR of 60 bits of each one's SHA-256.

    No quick function reads a hash's digits as a number, but `crc32` gives one of any four bytes, and their XOR follows from
    that of their CRCs.
    """
    text = key.cast("string")
    head = F.unhex(F.substring(F.sha2(text, 256), 1, 16))
    odd = F.count(text) % 2 * zlib.crc32(bytes(4))

    def half(at: int) -> Column:
        start = F.struct(F.bit_xor(F.crc32(F.substring(head, at, 4))).bitwiseXOR(odd).alias("left"), F.lit(0).cast("long").alias("found"))
        step = lambda acc, c: F.struct(F.shiftright(acc["left"], 1).alias("left"), acc["found"].bitwiseXOR(acc["left"].bitwiseAND(1) * c).alias("found"))
        return F.aggregate(F.array(*(F.lit(c).cast("long") for c in _crc_columns())), start, step, lambda acc: acc["found"])

    return F.shiftleft(half(1), 28).bitwiseOR(F.shiftright(half(5), 4))
