"""Tokens of N-Quads lines, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of a token and of a literal's text.
TOKEN = r'(<[^>]+>|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]+>|@\w+)?|_:\w+)'
PAIR = r"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})"
LITERAL = r'^"((?:[^"\\]|\\.)*)"'


def tokens(line: Column) -> Column:
    """The first four tokens, or null where there are fewer."""
    found = F.regexp_extract_all(line, F.lit(TOKEN), F.lit(1))
    return F.when(F.size(found) >= 4, F.slice(found, 1, 4))


def value(token: Column, compat: bool = False) -> Column:
    """An IRI's inside, a literal's unescaped text, null for a blank node.

    Escapes of one letter and of four hex digits are decoded; compat then reads the UTF-8 bytes as Latin-1.
    """
    text = F.regexp_extract(token, LITERAL, 1)
    out = text
    for raw, plain in ((r"\n", "\n"), (r"\t", "\t"), (r"\r", "\r"), (r"\"", '"')):
        out = F.replace(out, F.lit(raw), F.lit(plain))
    # Two escapes that are one character become one mark with both; half of such a pair stands for nothing.
    paired = F.regexp_replace(out, PAIR, "\x01$1$2")
    utf16 = lambda digits: F.decode(F.unhex(digits), "UTF-16BE")
    rest = lambda p, at: F.substring(p, at, 2**31 - 1)
    point = lambda p: F.when(F.rlike(p, F.lit(r"^\\u[dD][89a-fA-F]")), "\ufffd").otherwise(utf16(F.substring(p, 3, 4)))
    decoded = lambda p: F.when(F.rlike(p, F.lit(r"^\x01[0-9A-Fa-f]{8}")), F.concat(utf16(F.substring(p, 2, 8)), rest(p, 10))).when(F.rlike(p, F.lit(r"^\\u[0-9A-Fa-f]{4}")), F.concat(point(p), rest(p, 7))).otherwise(p)
    pieces = F.split(paired, r"(?=\\u[0-9A-Fa-f]{4})|(?=\x01)")
    out = F.when(F.contains(out, F.lit("\\u")), F.array_join(F.transform(pieces, decoded), "")).otherwise(out)
    out = F.replace(out, F.lit("\\\\"), F.lit("\\"))
    if compat:
        out = F.decode(F.encode(out, "UTF-8"), "ISO-8859-1")
    inside = F.regexp_extract(token, "^<(.*)>$", 1)
    return F.when(F.startswith(token, F.lit("<")) & F.endswith(token, F.lit(">")), inside).when(F.startswith(token, F.lit('"')), out)
