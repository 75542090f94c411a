import random

import pytest

import corpus_pipeline as P
from quarrymark.llm import jaccard as J
from quarrymark.llm import secrets as S
from quarrymark.llm import toxicity as T
from tests.llm.test_decontaminate import brute as leaks


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r = random.Random(3)
    vocab = ["".join(r.choices("abcdefghij", k=r.randint(2, 6))) for _ in range(300)]
    item = " ".join(r.choices(vocab, k=14))
    docs, labels = [], []
    for i in range(240):
        w = r.choices(vocab, k=r.randint(60, 120))
        if i % 6 == 0:
            w[5:9] = ["vile", "rotten", "scummy", "foul"]
        if i % 10 == 1:
            w[10:10] = item.split()
        if i % 10 == 2:
            w[3:3] = ["password=hunter2hunter2"]
        docs.append((i, " ".join(w), "en", "abc"[i % 3]))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 6 == 0)))
    docs += [(300 + k, docs[7][1] + " more", "en", "a") for k in range(5)] + [(400, None, "en", None), (401, "", None, "b")]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    bench = [(1, spark.read.parquet(f"{sf}/benchmark.parquet").first().text)]
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = docs.collect()
        ids = {x.doc_id for x in after}
        if name == "toxicity":
            assert ids == {x.doc_id for x in before if x.doc_id % 6 or x.doc_id >= 240}
        elif name == "near_duplicates":
            assert ids == {x.doc_id for x in before if not 300 <= x.doc_id < 400}
        elif name == "decontamination":
            bad = {x[0] for x in leaks([(x.doc_id, x.text) for x in before], bench, 10) if x[5]}
            assert bad and ids == {x.doc_id for x in before} - bad
        elif name == "secrets":
            texts = {x.doc_id: x.text for x in after}
            assert ids == {x.doc_id for x in before}
            assert all(texts[x.doc_id] == (x.text and x.text.replace("password=hunter2hunter2", "[secret]")) for x in before)
            assert all(x.n_chars == (len(x.text) if x.text is not None else None) for x in after)
        else:
            assert ids == {x.doc_id for x in before}
        if k + 1 < len(P.STAGES):
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_run_is_the_stages(spark, sf):
    assert P.run(spark, sf).count() > 100
    assert [f.__name__ for f in (T.drop_toxic, J.keep_one, S.redact)]
