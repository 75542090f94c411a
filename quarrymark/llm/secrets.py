"""Secret scans with DataFrame functions only.

Patterns find assignments, access keys and hex runs. Beside them, character Markov models judge every long token: first
differences of characters are counted over labelled samples of random strings (in several alphabets) and of ordinary
identifiers, and a token whose log-likelihood ratio favours one of the random models is a secret too. The models are
counts of character pairs, so their size is bounded by the alphabet; they enter the plan as constant arrays.

Positions are code points. Spark has no function for the places of matches, so they are running sums of the lengths of
what split() leaves between matches and of the matches; sums are made in two levels, to stay cheap for very many of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Tokens that the models judge; exact hex runs and access keys have their own kinds.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?!(?:[0-9a-f]{24,}|AKIA[A-Z0-9]{16,})(?![A-Za-z0-9+/_-]))[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Nats by which a random model must be likelier.
MARGIN = 12.0
#: Labelled strings of each kind.
SAMPLES = 4000
#: Words of the ordinary samples (fixed values).
COMMON = "access account action active add address admin after all api app array auth average back base batch before block body bucket buffer build button byte cache call cancel case change char check child class clean client close code column command config connect content context control copy count create current custom data date default delete detail device dialog document domain download draft edit element email enable encode engine entry error event example export factory false feature field file filter final first folder format frame from function general get global graph group handle handler hash header height hidden history home host icon image import index info init input insert instance integer internal into item java job json key label last layout length level library license limit line link list load local location lock login loop main make manager map master member memory menu message meta method model module month mount move name native network next node note null number object offset open option order output owner page parameter parent parse part password path pattern payment person place player plugin point policy port post prefix preview price print process product profile project property provider public query queue random range rate read receive record region release remove render replace report request reset resource response result return role root route rule sample save schema score screen script search second section select send server service session set shadow shape share shop show side sign simple single size slot sort source stack start state static status step stop storage store stream string style submit suffix support switch symbol system table tag target task template test text thread time title toggle token tool top total track trade transfer tree true type undo union unit until update upload user util valid value vector version video view visible wait watch web week weight widget width window word worker wrap write year zone"

#: Words of other languages in the ordinary samples (fixed values).
WORLD = "zwischen schreiben gesetzlich verwaltung gesellschaft wirtschaft freundschaft deutschland geschichte rechtschreibung strasse schiffahrt dampfmaschine versicherung uebersetzung fleischer ueberwachung aufgaben pflicht kraftwerk etikett arbeiter bescheid unfall kranken nachricht sprechen zeitschrift elektrisch betrieb flugzeug schwierigkeit quelle jetzt zoologie hoffnung grundstueck bezirk kapitel beaujolais quelque aujourdhui electronique developpement gouvernement deuxieme oiseau feuille chaque philosophie psychologie mouvement rhythme zephyr hexagone phobie nationalite reconnaitre oeuvre jeunesse bibliotheque montagne compagnie qualite voyageur desarrollo administracion ciencia cualquier izquierda trabajador hijo conocimiento jefe ejemplo riqueza exigencia guerrero lluvia llave oxigeno nucleo acido encefalo larinx grafista cruzar razonamiento estrella zapato queso bosque viejo przyjaciel szczegol czlowiek przedsiebiorstwo gospodarka rzeczpospolita wszystko dziewczyna szkola jezyk ksiazka zwyczaj miasto krzyz wiedza mieszkanie swiat czytac zielony chrzest konstytucja polityczny dzien wzgorze zycie niczyj wycieczka sciezka ragazzo giornata bellezza coscienza piccolo maggiore acqua chiesa ghiaccio schiavo zucchero viaggio immunologia endocrino neurologo sovrano magnifico precipizio vijftig schrijver koninkrijk gezondheid vrijheid huwelijk zelfstandig wetenschap"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(lengths: Column, width: int = 64, add: Callable[[Column, Column], Column] = lambda x, y: x + y) -> Column:
    """Inclusive running sums of an array of longs; arrays are only extended within a chunk and chunk by chunk.

    add: what else to run instead of sums, from 0 on.
    """

    def grow(acc: Column, x: Column) -> Column:
        return F.struct(add(acc["s"], x).alias("s"), F.concat(acc["a"], F.array(add(acc["s"], x))).alias("a"))

    none = F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("a"))

    def chunked(n: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / width).cast("int")), lambda c: F.aggregate(F.slice(n, c * width + 1, F.lit(width)), none, grow, lambda acc: acc["a"]))

    def joined(chunks: Column) -> Column:
        before = F.aggregate(chunks, none, lambda acc, ch: F.struct(add(acc["s"], F.element_at(ch, -1)).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")), lambda acc: acc["a"])
        return F.flatten(F.zip_with(chunks, before, lambda ch, b: F.transform(ch, lambda x: add(x, b))))

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(let(let(lengths, chunked), joined))


NONE = "array<struct<a:bigint,rank:int,b:bigint,hit:string>>"


def places(text: Column, pattern: str, rank: int, guard: Column | None = None) -> Column:
    """The leftmost non-overlapping matches: start, rank of their kind, end, text."""

    def spans(v: Column) -> Column:
        ends = running_sums(F.zip_with(F.slice(v["gaps"], F.lit(1), F.size(v["hits"])), v["hits"], lambda g, h: (F.length(g) + F.length(h)).cast("long")))
        return F.zip_with(v["hits"], ends, lambda h, e: F.struct((e - F.length(h)).alias("a"), F.lit(rank).alias("rank"), e.alias("b"), h.alias("hit")))

    found = let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), spans)
    has = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(has, found).otherwise(F.array().cast(NONE))


def labelled_samples(spark: SparkSession, n: int = SAMPLES) -> DataFrame:
    """Strings with their kind: ordinary identifiers made of common words, and hashes in the alphabets of secrets."""
    kinds_of_words = [F.array(*(F.lit(w) for w in x.split())) for x in (COMMON, WORLD)]
    words = F.when(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) == 0, kinds_of_words[1]).otherwise(kinds_of_words[0])
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.size(words)) + 1).cast("int"))
    some = F.array(*(pick(k) for k in range(6)))
    some = F.slice(some, F.lit(1), (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(4)) + 3).cast("int"))
    style = F.pmod("id", F.lit(10))
    short = F.array_join(F.transform(some, lambda w, i: w.substr(F.lit(1), (F.pmod(i + F.col("id"), F.lit(3)) + 2).cast("int"))), "_")
    number = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(10000)).cast("string")
    camel = F.array_join(F.transform(some, F.initcap), "")
    ordinary = (
        F.when(style == 0, F.array_join(some, "_")).when(style == 1, F.array_join(some, "-")).when(style == 2, F.array_join(some, "/")).when(style == 3, camel)
        .when(style == 4, F.concat(F.array_join(some, "_"), F.lit("_"), number)).when(style == 5, F.upper(F.array_join(some, "_"))).when(style == 6, F.array_join(some, ""))
        .when(style == 7, F.upper(F.concat(short, F.lit("_"), pick(6)))).when(style == 8, F.concat(pick(7), F.lit("_"), short, number)).otherwise(F.concat(camel, number))
    )
    digest = F.sha2(F.concat(F.lit("sample:"), F.col("id").cast("string")), 256)
    more = F.sha2(F.concat(F.lit("more:"), F.col("id").cast("string")), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(F.concat(digest, more))), "\\s", "")
    ruler = F.repeat(F.substring(F.lit(ALPHABET), (F.pmod("id", F.lit(len(ALPHABET))) + 1).cast("int"), F.lit(1)), F.lit(24))
    kinds = [("ordinary", ordinary), ("ordinary", ruler), ("hex", digest), ("base64", base64), ("base62", F.regexp_replace(base64, "[+/=]", "")), ("upper", F.conv(F.substring(digest, 1, 15), 16, 36)), ("lower", F.lower(F.conv(F.substring(more, 1, 15), 16, 36))), ("urlsafe", F.translate(base64, "+/", "-_"))]
    ids = spark.range(n)
    out = None
    for kind, column in kinds:
        part = ids.select(F.lit(kind).alias("kind"), column.alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


def train_models(samples: DataFrame) -> dict[str, list[float]]:
    """For each random kind, the log-likelihood ratio to the ordinary model of each pair of characters.

    samples: kind, text; the kind "ordinary" is needed. Pairs are smoothed by one half of a count; characters outside the
    alphabet (and null or short texts) count for nothing. A pair's index is 68 times its first character's place plus its
    second's.
    """
    m = len(ALPHABET) + 1
    chars = samples.select("kind", F.split(F.coalesce("text", F.lit("")), "").alias("c"))
    pairs = chars.select("kind", F.explode(F.arrays_zip(F.slice("c", F.lit(1), F.greatest(F.size("c") - 1, F.lit(0))).alias("x"), F.slice("c", F.lit(2), F.size("c")).alias("y"))).alias("p"))
    rows = pairs.select("kind", F.instr(F.lit(ALPHABET), F.col("p.x")).alias("x"), F.instr(F.lit(ALPHABET), F.col("p.y")).alias("y")).filter("x > 0 AND y > 0").groupBy("kind", "x", "y").count().collect()
    counts: dict[str, dict[tuple[int, int], int]] = {}
    for r in rows:
        counts.setdefault(r["kind"], {})[r["x"], r["y"]] = r["count"]

    def logs(own: dict[tuple[int, int], int]) -> list[float]:
        total = [0.5 * (m - 1)] * m
        for (x, _), n in own.items():
            total[x] += n
        return [math.log((own.get((x, y), 0) + 0.5) / total[x]) if x and y else 0.0 for x in range(m) for y in range(m)]

    plain = logs(counts.get("ordinary", {}))
    return {k: [a - b for a, b in zip(logs(v), plain, strict=True)] for k, v in sorted(counts.items()) if k != "ordinary"}


def log_ratio(token: Column, models: dict[str, list[float]]) -> Column:
    """The greatest log-likelihood ratio of a random model to the ordinary one."""
    m = len(ALPHABET) + 1
    # One constant array each, which the optimizer folds: thousands of literals would slow planning.
    tables = [F.split(F.lit(",".join(f"{x:.5f}" for x in t)), ",").cast("array<double>") for t in models.values()]

    def summed(index: Column, table: Column) -> Column:
        return F.aggregate(index, F.lit(0.0), lambda acc, i: acc + F.element_at(table, i))

    def of(index: Column) -> Column:
        sums = [summed(index, t) for t in tables]
        return F.greatest(*sums) if len(sums) > 1 else sums[0] if sums else F.lit(0.0)

    def pairs(place: Column) -> Column:
        n = F.size(place)
        return F.zip_with(F.slice(place, F.lit(1), n - 1), F.slice(place, F.lit(2), n - 1), lambda x, y: x * m + y + 1)

    place = F.transform(F.split(token, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c)))
    return let(let(place, pairs), of)


def secret_spans(text: Column, models: dict[str, list[float]], margin: float = MARGIN) -> dict[str, Column]:
    """The spans of each kind in a text that isn't null."""
    assign = F.filter(places(text, ASSIGN, 0, text.contains("=") | text.contains(":")), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= 6)
    token = F.filter(places(text, TOKEN, 3), lambda s: log_ratio(s["hit"], models) >= margin)
    return dict(zip(KINDS, (assign, places(text, ACCESS, 1, text.contains("AKIA")), places(text, HEX, 2), token), strict=True))


def scan_secrets(docs: DataFrame, models: dict[str, list[float]] | None = None, margin: float = MARGIN) -> DataFrame:
    """Secrets in every whole text of docs (doc_id, text).

    A row out for each row in: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 (of the first three kinds' spans) and
    spans (all). A span is kind:start:end of the whole match in code points, end exclusive, in order of start, then kind.
    Matches of one kind don't overlap; those of different kinds may, and a model's span may lie in an assignment. Null and
    empty texts have no spans. Repeated rows are scanned one by one.
    """
    models = train_models(labelled_samples(docs.sparkSession)) if models is None else models
    found = docs.select("doc_id", *(c.alias(k) for k, c in secret_spans(F.coalesce(F.col("text"), F.lit("")), models, margin).items()))
    names = F.array(*(F.lit(k) for k in KINDS))

    def listed(spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["a"].alias("a"), s["rank"].alias("rank"), s["b"].alias("b"))))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["a"].cast("string"), s["b"].cast("string"))), ",")

    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed(F.concat("assign", "access", "hex")), 256).alias("base_sha256"), listed(F.concat("assign", "access", "hex", "markov")).alias("spans"),
    )


def masked_spans(text: Column, spans: Column, mask: str, width: int = 64) -> Column:
    """text with a mask for each stretch of overlapping spans (structs of a and b); pieces are cut from chunks of the text."""

    def cut(v: Column) -> Column:
        n = F.size(v["own"])

        def chunk(c: Column) -> Column:
            own, lo = F.slice(v["own"], c * width + 1, F.lit(width)), F.slice(v["lo"], c * width + 1, F.lit(width))
            first, last = F.element_at(lo, 1), F.element_at(own, -1)["a"]
            piece = F.struct(own.alias("own"), lo.alias("lo"), first.alias("first"), text.substr((first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int")).alias("part"))
            return let(piece, lambda p: F.array_join(F.zip_with(p["own"], p["lo"], lambda s, m: F.when(s["a"] >= m, F.concat(p["part"].substr((m - p["first"] + 1).cast("int"), (s["a"] - m).cast("int")), F.lit(mask))).otherwise("")), ""))

        chunks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), chunk)
        return F.concat(F.array_join(chunks, ""), text.substr((v["end"] + 1).cast("int"), F.length(text)))

    def ends(own: Column) -> Column:
        most = running_sums(F.transform(own, lambda s: s["b"]), width, F.greatest)
        return let(F.struct(own.alias("own"), most.alias("most")), lambda v: let(F.struct(v["own"].alias("own"), F.concat(F.array(F.lit(0).cast("long")), F.slice(v["most"], F.lit(1), F.size(v["most"]) - 1)).alias("lo"), F.element_at(v["most"], -1).alias("end")), cut))

    return let(F.array_sort(spans), lambda own: F.when(F.size(own) == 0, text).otherwise(ends(own)))


def redact(docs: DataFrame, models: dict[str, list[float]] | None = None, margin: float = MARGIN, mask: str = "[secret]") -> DataFrame:
    """docs, all columns, with a mask for each secret of its text.

    What is masked is exactly the union of the spans of scan_secrets(), found in the original text: each stretch of overlapping
    spans is one mask, and all else stays as it was. Null and empty texts stay as they are.
    """
    models = train_models(labelled_samples(docs.sparkSession)) if models is None else models
    found = secret_spans(F.col("text"), models, margin)
    spans = F.concat(*(F.transform(found[k], lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"))) for k in KINDS))
    masked = masked_spans(F.col("text"), spans, mask)
    return docs.withColumn("text", F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, masked).otherwise(F.col("text")))
