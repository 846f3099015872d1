import random

import numpy as np
from pyspark.sql import functions as F

from prepframe.llm import pu


def test_prior_and_risk():
    r = np.random.RandomState(1)
    pos, neg = r.randn(3000, 4), r.randn(3000, 4) + np.array([4, 0, 0, 0])
    unl = np.concatenate([pos[:2100] + 0.01, neg[:900]])
    model = pu.fit_pu(pos, unl)
    assert 0.6 <= model.prior <= 0.85
    assert (model.score(r.randn(1000, 4)) >= 0.5).mean() > 0.9
    assert (model.score(r.randn(1000, 4) + np.array([4, 0, 0, 0])) < 0.5).mean() > 0.9


def test_statistics():
    assert pu.statistics("") == [0.0] * len(pu.FEATURES) == pu.statistics(" \n ")
    s = dict(zip(pu.FEATURES, pu.statistics("Ab ab ab!\nAb ab ab!\n#x 12")))
    assert s["symbols"] == 1 / 8 and s["exclaim"] == 2 / 8 and round(s["repeated_lines"], 3) == 0.333 and s["echo"] == 0


def test_held_out_accuracy(spark):
    r = random.Random(2)
    vocab = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(500)]
    rows = []
    for i in range(900):
        w = [r.choice(vocab) for _ in range(r.randint(30, 200))]
        good = i % 5 != 0
        t = " ".join(w).capitalize() + "." if good else [" ".join(x + "%%%" for x in w), " ".join(x for x in w[:12] for _ in range(9)), " | ".join(w)][i % 3]
        rows.append((i, t, int(good)))
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(2000, None, 1), (2001, "", 1), (2001, "", 1)], "doc_id long, text string, stats int").repartition(4)
    labels = spark.createDataFrame([(i, y if i % 2 else None) for i, _, y in rows], "doc_id long, quality int")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    got = [x for x in pu.positive_unlabelled(docs, labels, fold).collect()]
    assert len(got) == 903 and all(0 <= x["score"] <= 1 for x in got)
    truth = {i: y for i, _, y in rows}
    held = [(x["predicted"], truth[x["doc_id"]]) for x in got if x["held_out"] and x["doc_id"] in truth]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    none = pu.positive_unlabelled(docs, labels.where("quality = 7"), fold).select("score").distinct().collect()
    assert [x[0] for x in none] == [0.5]
    assert pu.positive_unlabelled(docs.limit(0), labels, fold).collect() == []
