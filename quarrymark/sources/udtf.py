"""N-Quads parsing as a table function for SQL: SELECT * FROM quads_of(TABLE(lines))."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn
from pyspark.sql.types import BooleanType, LongType, StringType, StructType
from pyspark.sql.udtf import UserDefinedTableFunction

from ..functions.nquads import LITERAL, PAIR, TOKEN

_TOKEN, _LITERAL = re.compile(TOKEN), re.compile(LITERAL, re.DOTALL)
_PAIR, _UNICODE = re.compile(PAIR), re.compile(r"\\u([0-9A-Fa-f]{4})")


def _iri(token: str) -> str:
    return token.strip("<>")


def _point(digits: str) -> str:
    at = int(digits, 16)
    return "\ufffd" if 0xD800 <= at < 0xE000 else chr(at)


def _value(token: str) -> str | None:
    if token.startswith("<") and token.endswith(">"):
        return token[1:-1]
    if not token.startswith('"'):
        return None
    text = _LITERAL.match(token)[1]
    for raw, plain in ((r"\n", "\n"), (r"\t", "\t"), (r"\r", "\r"), (r"\"", '"')):
        text = text.replace(raw, plain)
    text = _PAIR.sub(lambda m: bytes.fromhex(m[1] + m[2]).decode("utf-16-be"), text)
    return _UNICODE.sub(lambda m: _point(m[1]), text).replace("\\\\", "\\")


class QuadsOf:
    """Of a table with line, and file and line_no or other columns by which it is dealt and ordered: a row for each quad, with the number of its run of
    one subject and source. Lines of a file come in order, one by one, so no more than a line is held."""

    @staticmethod
    def analyze(lines: AnalyzeArgument, by: AnalyzeArgument | None = None, order: AnalyzeArgument | None = None) -> AnalyzeResult:
        names = [str(a.value) if a is not None and a.isConstantExpression else d for a, d in ((by, "file"), (order, "line_no"))]
        if not lines.isTable:
            raise ValueError("quads_of() takes a table")
        given = {f.name: f.dataType for f in lines.dataType}
        if missing := [c for c in (*names, "line") if c not in given]:
            raise ValueError(f"quads_of() misses {', '.join(missing)}")
        out = StructType()
        for c in names:
            out = out.add(c, given[c])
        for c in ("subject", "property", "value", "source_url"):
            out = out.add(c, StringType())
        out = out.add("run", LongType()).add("opens", BooleanType())
        chosen = [SelectedColumn(c) for c in (*names, "line")]
        return AnalyzeResult(out, partitionBy=[PartitioningColumn(names[0])], orderBy=[OrderingColumn(names[1])], select=chosen)

    def __init__(self) -> None:
        self.run, self.last = -1, None

    def eval(self, lines: Row, by: str | None = None, order: str | None = None) -> Iterator[tuple]:
        file, place, line = lines
        if line is None or not line.strip(" ") or line.strip(" ").startswith("#"):
            return
        tokens = _TOKEN.findall(line)[:4]
        if len(tokens) < 4:
            return
        subject, source = _iri(tokens[0]), _iri(tokens[3])
        opens = (subject, source) != self.last
        if opens:
            self.run, self.last = self.run + 1, (subject, source)
        yield file, place, subject, re.split("[/#]", _iri(tokens[1]))[-1], _value(tokens[2]), source, self.run, opens


def register(spark: SparkSession, name: str = "quads_of") -> UserDefinedTableFunction:
    """Make the function known to the session's SQL."""
    from pyspark.sql.functions import udtf

    made = udtf(QuadsOf)
    spark.udtf.register(name, made)
    return made
