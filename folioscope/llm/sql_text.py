"""Pieces of oracle SQL shared by queries."""

from __future__ import annotations

POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed


def _entry(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (POLYNOMIAL if value & 1 else 0)
    return value


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a string's UTF-8 bytes as a DuckDB expression, one table step a byte."""
    steps = ", ".join(str(_entry(i)) for i in range(256))
    digits = f"hex(encode({text}))"
    byte_list = f"list_transform(range(1, len({digits}), 2), lambda i: ('0x' || substr({digits}, i, 2))::BIGINT)"
    return (f"xor(list_reduce({byte_list}, lambda crc, b: xor(crc >> 8, ([{steps}]::BIGINT[])[(xor(crc, b) & 255) + 1]), 4294967295::BIGINT), "
            "4294967295::BIGINT)")
