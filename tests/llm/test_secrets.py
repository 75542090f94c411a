import base64
import hashlib
import os
import random
import re
import socket
import ssl

import numpy as np
import pytest

from quarrymark.llm import secrets as S

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def brute(text):
    text = text or ""
    a = [m for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    k = [m for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    h = [m for m in HEX.finditer(text) if len(m[0]) >= 24]
    spans = sorted((m.start(), r, m.end()) for r, own in enumerate((a, k, h)) for m in own)
    line = ",".join(f"{S.KINDS[r]}:{x}:{y}" for x, r, y in spans)
    return len(a), len(k), len(h), hashlib.sha256(line.encode()).hexdigest(), line


def texts(seed):
    r = random.Random(seed)
    bits = ["password", "PassWd", "secret", "token", "apikey", "API_key", "=", ":", " ", '"', "'", "abcdef", "abc", "x.y/z+=", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef01234567", "deadbeef", "é", "𝄞", "\n", "K", "ſecret"]
    out = ["", None, "token=token:abcdefgh", "password=" + "a" * 5000, "AKIA" + "A" * 16, "AKIA" * 5, "f" * 24, "f" * 23, " ".join(["token=abcdefg"] * 300)]
    return out + ["".join(r.choices(bits, k=r.randint(1, 40))) for _ in range(300)]


def test_base_spans_against_brute_force(spark):
    t = texts(1)
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").selectExpr("*", "1 AS hex", "2 AS spans")
    got = {x.doc_id: x for x in S.scan_secrets(docs).collect()}
    assert len(got) == len(t)
    for i, x in enumerate(t):
        want = brute(x)
        g = got[i]
        assert (g.n_assign, g.n_access, g.n_hex, g.base_sha256) == want[:4], x
        base = ",".join(s for s in g.spans.split(",") if s and not s.startswith("markov"))
        assert base == want[4]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = S.scan_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def models(spark):
    return S.train_models(S.labelled_samples(spark))


def test_held_out(spark, models):
    r = random.Random(9)
    secrets = ["".join(r.choices(S.ALPHABET[:62], k=24)) for _ in range(200)] + ["".join(r.choices("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=24)) for _ in range(100)]
    plain = ["getElementByIdentifierName", "src/main/resources/config/application", "internationalization_of_everything", "Donaudampfschifffahrtsgesellschaft", "MAXIMUM_CONNECTION_POOL_SIZE", "heitungkeitlichverenschein", "user-profile-settings-page-2024", "aaaaaaaaaaaaaaaaaaaaaaaaaa", "----------------------------", "=" * 40, "ABSTRACTIONSCHICHTEN_DER_VERWALTUNG"]
    rows = [(i, f"see {s} there") for i, s in enumerate(secrets + plain)]
    got = {x.doc_id: x.n_markov for x in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), models).collect()}
    assert sum(got[i] for i in range(300)) >= 290
    assert [plain[i] for i in range(len(plain)) if got[300 + i]] == []


def test_span_positions_and_redaction(spark, models):
    key = "q7Zk2LxP9vTb4RwYc8Nd3Hs6"
    rows = [(1, f"é𝄞 {key} end"), (2, 'token = "abcdef12" x'), (3, None), (4, "nothing here"), (5, "AKIA" + "B" * 16 + " " + "0a" * 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.spans for x in S.scan_secrets(docs, models).collect()}
    assert got[1] == "markov:3:27" and got[2] == "assign:0:17" and got[3] == got[4] == ""
    text = {x.doc_id: x.text for x in S.redact(docs, models).collect()}
    assert text == {1: "é𝄞 [secret] end", 2: '[secret]" x', 3: None, 4: "nothing here", 5: "[secret] [secret]"}
    assert S.scan_secrets(docs.filter("false"), models).count() == 0
    assert S.train_models(docs.selectExpr("'ordinary' AS kind", "text").filter("false")) == {}


def test_redaction_masks_all_spans(spark, models):
    r = random.Random(4)
    alphabet = S.ALPHABET[:62]
    out = ["sk-live_" + "".join(r.choices("0123456789abcdef", k=24)) + "XYZ9" for _ in range(3)] + ["token=token:secret: abcdefgh", " ".join(f"{i:024x}" for i in range(300)), "é𝄞 token=" + "".join(r.choices(alphabet, k=30)) + ".abc end"]
    out += [t for t in texts(2) if t] + ["é " + "-".join("".join(r.choices(alphabet if k % 2 else "0123456789abcdef", k=24)) for k in range(3)) + " z"]
    docs = spark.createDataFrame(list(enumerate(out)), "doc_id long, text string")
    spans = {x.doc_id: x.spans for x in S.scan_secrets(docs, models).collect()}
    got = {x.doc_id: x.text for x in S.redact(docs, models).collect()}
    for i, t in enumerate(out):
        inside, joined = [False] * len(t), [False] * len(t)
        for _, a, b in (x.split(":") for x in spans[i].split(",") if x):
            inside[int(a) : int(b)] = [True] * (int(b) - int(a))
            joined[int(a) + 1 : int(b)] = [True] * (int(b) - int(a) - 1)
        want = "".join("[secret]" if h and not j else "" if h else c for c, h, j in zip(t, inside, joined, strict=True))
        assert got[i] == want
    assert got[4] == " ".join(["[secret]"] * 300) and got[5] == "é𝄞 [secret] end"


def test_overlapping_kinds_are_masked_whole(spark, models):
    rows = [(1, "commit 0123456789abcdef01234567-XyZkq9Lm0Pq2Rt7Wv5"), (2, "password: token: abcdefgh12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {x.doc_id: x.spans for x in S.scan_secrets(docs, models).collect()}
    got = {x.doc_id: x.text for x in S.redact(docs, models).collect()}
    assert "markov:7:50" in spans[1] and got[1] == "commit [secret]"
    assert bool(spans[2]) == (got[2] != rows[1][1])


def log_ratio(token, models):
    place = {c: k + 1 for k, c in enumerate(S.ALPHABET)}
    m = len(S.ALPHABET) + 1
    return max(sum(t[place.get(x, 0) * m + place.get(y, 0)] for x, y in zip(token, token[1:])) for t in models.values())


def test_markov_spans_against_brute_force(spark, models):
    r = random.Random(12)
    t = ["".join(r.choices(S.ALPHABET[:62] + "_-/ é", k=r.randint(10, 120))) for _ in range(200)] + [" ".join(dir(str)), "/".join(dir(list)), "x" * 40, "=" * 40]
    docs = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {x.doc_id: [s for s in x.spans.split(",") if s.startswith("markov")] for x in S.scan_secrets(docs, models).collect()}
    for i, text in enumerate(t):
        close = [m for m in re.finditer(S.TOKEN, text) if abs(log_ratio(m[0], models) - S.MARGIN) < 0.01]  # tables hold five decimals
        want = [f"markov:{m.start()}:{m.end()}" for m in re.finditer(S.TOKEN, text) if log_ratio(m[0], models) >= S.MARGIN]
        assert close or got[i] == want


def test_rates_on_real_identifiers_and_languages(spark, models):
    """Public names of libraries, and long words and paths in four languages: few are called secrets, and random tokens nearly all are."""
    import pandas
    import pyarrow
    import pyspark.sql.functions

    names = sorted({n for o in (pandas, pandas.DataFrame, np, pyarrow, pyarrow.compute, pyspark.sql.functions, os, socket, ssl) for n in dir(o) if len(n) >= 20})
    words = (
        "Rindfleischetikettierungsueberwachungsaufgabenuebertragungsgesetz Donaudampfschifffahrtselektrizitaeten Hauptbetriebswerkbauunterbeamtengesellschaft Geschwindigkeitsbegrenzung Arbeitsunfaehigkeitsbescheinigung "
        "anticonstitutionnellement intergouvernementalisations hexakosioihexekontahexaphobie electroencefalografista desoxirribonucleotidos internacionalizaciones otorrinolaringologicamente "
        "precipitevolissimevolmente psiconeuroendocrinoimmunologia sovramagnificentissimamente Przemyszczyzna/Konstantynopolitanczykowianeczka internationalisation/reconnaissance "
        "https/www/example/wiki/Przemyszczyzna_gospodarka en/wiki/List_of_common_misconceptions src/test/java/org/example/service/UserServiceTest"
    ).split()
    words = [w for w in words if len(w) >= 20]
    r = random.Random(21)
    random_ = ["".join(r.choices(S.ALPHABET[:62], k=r.randint(22, 44))) for _ in range(300)] + [base64.b64encode(r.randbytes(24)).decode() for _ in range(100)] + [base64.urlsafe_b64encode(r.randbytes(30)).decode().strip("=") for _ in range(100)]
    rows = list(enumerate([f"see {x} there" for x in [*names, *words, *random_]]))
    got = [x.n_markov > 0 for x in S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), models).orderBy("doc_id").collect()]
    a, b = len(names), len(names) + len(words)
    assert len(names) > 100 and sum(got[:a]) <= 0.02 * a, [n for n, g in zip(names, got) if g]
    assert sum(got[a:b]) <= 1, [w for w, g in zip(words, got[a:]) if g]
    assert sum(got[b:]) >= 0.97 * len(random_)


def test_very_many_matches(spark, models):
    rows = [(1, " ".join(f"{i:024x}" for i in range(5000)))]
    got = S.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), models).collect()[0]
    assert got.n_hex == 5000 and got.spans.endswith("hex:124975:124999")
