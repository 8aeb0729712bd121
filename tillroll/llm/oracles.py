"""DuckDB SQL shared by the oracles."""

# CTE ``crc``: one row, ``t`` the table of the CRC-32 polynomial (fixed value) by byte.
CRC_TABLE = """crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc32(text: str) -> str:
    """The CRC-32 (unsigned) of an ASCII expression, where ``crc.t`` is in scope."""
    return (f"xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), "
            "lambda ch: CAST(ascii(ch) AS BIGINT))), "
            "lambda a, b: xor(a >> 8, crc.t[CAST(xor(a & 255, b) AS INTEGER) + 1])))")
