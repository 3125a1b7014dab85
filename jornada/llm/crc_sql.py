"""CRC-32 in SQL, for queries that are compared with it."""

from __future__ import annotations

#: A table for CRC-32, by its rule; `crc_of` expects a list of byte values.
CRC_TABLE = """
crc_table as (
    select list(code order by i) codes from (
        select i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda a, x: case when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) code
        from (select unnest(range(256)) i)
    )
)"""


def crc_of(codes: str) -> str:
    """SQL of the unsigned CRC-32 of a list of byte values; `codes` of crc_table must be in scope."""
    return (
        f"xor(list_reduce(list_prepend(4294967295, {codes}), "
        "lambda a, b: xor(a >> 8, codes[(xor(a, b) & 255) + 1])), 4294967295)"
    )
