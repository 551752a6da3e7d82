"""Pieces of SQL that several queries' SQL shares."""

#: A recursive or plain WITH entry: ``crc_table.t``, the table of CRC-32 by byte, from its polynomial.
CRC_TABLE = "crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)))"


def crc32(codes: str) -> str:
    """The unsigned check sum of a list of byte values, beside crc_table."""
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
