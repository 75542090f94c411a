"""Fill-in-the-middle texts by lookaround splitting.

A unit grammar says what the pieces of a text are, as alternatives of character classes in a row: lines are
``[^\\n]*\\n|[^\\n]+``. boundary() translates it to a pattern without width that holds between two characters exactly where no
alternative goes on from the left one's class to the right one's. Spark's split() cuts there and keeps every character,
so that pieces are units and their concatenation is the text. An empty text would be one empty piece; it has no units.

Everything is a projection of its row: no shuffle, and nothing but the text and its pieces in memory.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import unused

#: Unit grammars by name; any other of the same form can be given instead.
UNITS = {
    "lines": r"[^\n]*\n|[^\n]+",
    "words": r"[^\s]+[\s]*|[\s]+",
    "sentences": r"[^.!?]*[.!?]+|[^.!?]+",
    "runs": r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]",
    "characters": r"[\s\S]",
}
_CLASS = re.compile(r"(\[\^?\]?(?:\\.|[^\]\\])*\]|\\.|[^\\\[\](){}.|*+?^$])([*+?]?)", re.DOTALL)


def boundary(grammar: str) -> str:
    """The pattern of the places between two units.

    grammar: alternatives of classes, escapes or plain characters, each with *, + or ? or none. Whether a unit goes on has to follow from
    two neighbouring characters, so no two of its alternatives may lead on differently from the same class, and a class may hold all
    characters beyond U+FFFF or none. Other syntax is a ValueError.
    """
    goes_on: dict[str, list[str]] = {}
    for alternative in _alternatives(grammar):
        for i, (left, many) in enumerate(alternative):
            after = [left] if many in ("*", "+") else []
            for right, how in alternative[i + 1 :]:
                after.append(right)
                if how not in ("*", "?"):
                    break
            for right in after:
                if right not in goes_on.setdefault(left, []):
                    goes_on[left].append(right)
    never = [left for left, rights in goes_on.items() if any(_complement(r) in rights for r in rights)]  # after these every character goes on
    first = "".join(f"(?<!{left})" for left in never)
    inner = "".join(f"(?!(?<={left})(?:{'|'.join(rights)}))" for left, rights in goes_on.items() if rights and left not in never)
    return rf"{first}(?<=[\s\S]){inner}(?=[\s\S])"


def _complement(one: str) -> str | None:
    """The other class of a pair like [x] or \\x and [^x], as [^x] or, of that, as it stands without brackets."""
    if one.startswith("[^"):
        return one[2:-1] if re.fullmatch(r"\\.|[^\\]", one[2:-1], re.DOTALL) else f"[{one[2:-1]}]"
    return f"[^{one[1:-1] if one.startswith('[') else one}]"


def _alternatives(grammar: str) -> list[list[tuple[str, str]]]:
    """Each alternative's (class, quantifier) pairs."""
    out: list[list[tuple[str, str]]] = [[]]
    at = 0
    while at < len(grammar):
        if grammar[at] == "|":
            out.append([])
            at += 1
        elif found := _CLASS.match(grammar, at):
            out[-1].append((found[1], found[2]))
            at = found.end()
        else:
            raise ValueError(f"not a unit grammar: {grammar!r} at {at}")
    if not all(out):
        raise ValueError(f"an empty alternative in {grammar!r}")
    return out


def units(text: Column, grammar: str = UNITS["lines"]) -> Column:
    """The units of a text as an array; none for an empty text, null for null."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(grammar), -1))


def _draw(key: Column, seed: int, n: int) -> Column:
    """The n-th (from 0) 8 hex digits of the key's sha256 as an unsigned number: the same on every run and machine."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * n + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, grammar: str = UNITS["lines"], seed: int = 7, rate: int = 100, spm: int = 50, tokens: tuple[str, str, str] = ("<P>", "<S>", "<M>"), text: str = "text") -> DataFrame:
    """docs (doc_id, text) with n_units, form, prefix, middle and output.

    A text is cut after two drawn numbers of units, which may be equal or at its ends. output is, by form: plain, the text;
    psm, prefix, suffix, middle; spm, suffix, prefix, middle, each behind its token (of prefix, suffix, middle in `tokens`).
    rate percent of documents are rearranged, spm percent of these as spm. Draws follow from seed and doc_id alone, so rows with one id
    are cut alike; a null id draws as an empty one. Null texts count as empty; empty texts, and those that hold a token themselves, are plain, with null
    prefix and middle. The five columns replace those of docs with such names; all others stay. A row out for each row in.
    """
    if len(set(tokens)) < 3 or any(not t or t[0] in u[1:] for t in tokens for u in tokens):
        raise ValueError("tokens have to differ, and the first character of one must not recur within any")
    cut = unused(docs, "_cut")
    own = F.coalesce(F.col(text), F.lit(""))
    part = lambda first, last: F.array_join(F.slice(F.col(cut)["u"], first, last), "")
    key = F.col("doc_id")
    rows = docs.withColumn(cut, F.struct(own.alias("text"), units(own, grammar).alias("u")))
    size = F.size(F.col(cut)["u"]).cast("long")
    a, b = (F.pmod(_draw(key, seed, i), size + 1) for i in (0, 1))
    plain = (F.col(cut)["text"] == "") | (_draw(key, seed, 2) % 100 >= rate)
    for t in tokens:
        plain = plain | F.contains(F.col(cut)["text"], F.lit(t))
    form = F.when(plain, "plain").when(_draw(key, seed, 3) % 100 < spm, "spm").otherwise("psm")
    rows = rows.withColumn(cut, F.struct(F.col(cut)["text"].alias("text"), F.col(cut)["u"].alias("u"), size.alias("n"), form.alias("form"), F.least(a, b).cast("int").alias("a"), F.greatest(a, b).cast("int").alias("b")))
    c = F.col(cut)
    first, mid, rest = part(F.lit(1), c["a"]), part(c["a"] + 1, c["b"] - c["a"]), part(c["b"] + 1, F.size(c["u"]))
    told = c["form"] != "plain"
    rows = rows.withColumn(cut, F.struct(c["text"].alias("text"), c["n"].alias("n"), c["form"].alias("form"), F.when(told, first).alias("p"), F.when(told, mid).alias("m"), F.when(told, rest).alias("s")))
    p, s, m = (F.lit(t) for t in tokens)
    psm, as_spm = F.concat(p, c["p"], s, c["s"], m, c["m"]), F.concat(s, c["s"], p, c["p"], m, c["m"])
    output = F.when(c["form"] == "plain", c["text"]).when(c["form"] == "psm", psm).otherwise(as_spm)
    return rows.withColumns({"n_units": c["n"], "form": c["form"], "prefix": c["p"], "middle": c["m"], "output": output}).drop(cut)


def restore(output: Column, form: Column, tokens: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that fill_in_middle() made an output of. Tokens stand once each in such an output, and no piece can complete one."""
    p, s, m = tokens
    ahead, middle = F.substring_index(output, m, 1), F.substring_index(output, m, -1)
    drop = lambda x, t: F.substring(x, len(t) + 1, 2**31 - 1)
    psm = F.concat(drop(F.substring_index(ahead, s, 1), p), middle, F.substring_index(ahead, s, -1))
    spm = F.concat(F.substring_index(ahead, p, -1), middle, drop(F.substring_index(ahead, p, 1), s))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
