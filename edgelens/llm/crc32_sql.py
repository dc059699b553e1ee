"""CRC-32 in DuckDB SQL, which has no such function."""

#: Common table expressions (of a ``WITH RECURSIVE``): the table of the polynomial, one list.
CRC_TABLE = """crc_steps AS (
    SELECT range AS i, range AS c, 0 AS step FROM range(256)
    UNION ALL
    SELECT i, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), step + 1 FROM crc_steps WHERE step < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS crc FROM crc_steps WHERE step = 8)"""


def crc32(text: str) -> str:
    """The CRC-32 of ``text``, of characters up to U+00FF, in UTF-8; ``crc_table`` is to be joined."""
    return f"""xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split({text}, ''), lambda x:
            CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                 ELSE [192 + unicode(x)::BIGINT // 64, 128 + unicode(x)::BIGINT % 64] END))),
        lambda c, b: xor(c >> 8, crc[1 + xor(c, b) % 256])), 4294967295::BIGINT)"""
