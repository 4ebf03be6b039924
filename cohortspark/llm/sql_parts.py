"""Pieces of SQL that several queries' SQL needs."""

from __future__ import annotations

#: Common tables ``crc_bits, crc_tab`` (one row, list ``tab``) for a WITH RECURSIVE; see ``crc32``.
CRC = """crc_bits AS (SELECT range AS i, CAST(range AS UBIGINT) AS c, 0 AS k FROM range(256)
             UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_tab AS (SELECT list(c ORDER BY i) AS tab FROM crc_bits WHERE k = 8)"""


def crc32(text: str) -> str:
    """CRC-32 of an expression's UTF-8 bytes; the query joins ``crc_tab``."""
    byte = f"CAST(instr('0123456789ABCDEF', hex({text})[2 * j + 1]) * 16 + instr('0123456789ABCDEF', hex({text})[2 * j + 2]) - 17 AS UBIGINT)"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(range(strlen({text})), lambda j: {byte})), "
            "lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT))")
