import random

import pytest

import corpus_pipeline as C
from prepframe.llm import queries


def prose(r, n):
    return " ".join(r.choice(["ab", "cde", "fgh", "ij", "klmn", "opq"]) + r.choice(["or", "et", "is", "un", "al", "ex"]) + r.choice(["a", "o", "ina", "e"]) for _ in range(n))


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    r, out = random.Random(9), str(tmp_path_factory.mktemp("sf"))
    docs, labels = [], []
    for i in range(120):
        t = prose(r, 80)
        bad = i % 4 == 0
        if bad:
            w = t.split()
            for k in (3, 20, 41, 60):
                w[k] = "blarg" if i % 8 or i < 60 else "bl4rg"
            t = " ".join(w)
        docs.append((i, t, "en", "s", len(t)))
        if i < 100:
            labels.append((i, 1, int(bad)))
    good = prose(r, 90)
    docs += [(200, good + " mail me@here.org", "en", "s", 9), (201, good + " mail me@here.org", "en", "s", 9), (202, good.replace("ab", "ab", 1) + " mail me@here.org x", "en", "s", 9)]
    docs += [(300, "too short", "en", "s", 9), (301, None, None, None, None), (302, "", "en", "s", 0), (303, "w### " * 200, "en", "s", 1000)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i for i in range(120) if i % 4}
    assert set(seen["quality_rules"]) == set(range(120)) | {200, 201, 202}
    assert set(seen["toxicity"]) == clean | {200, 201, 202}
    assert set(seen["ngram_jaccard_join"]) == clean | {200}
    assert set(seen["pii"]) == clean | {200}
    assert "me@here.org" not in seen["pii"][200] and seen["pii"][1] == seen["toxicity"][1]
    assert {i for i, in C.packing(spark, docs, sf).select("doc_id").collect()} == clean | {200}


def test_run_equals_the_stages(spark, sf):
    rows = C.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == {i for i in range(120) if i % 4} | {200}
    assert "pipeline" in queries.QUERIES and len([q for q in queries.QUERIES if q.startswith("op")]) == 10
