import random

from pyspark.sql import functions as F

from prepframe.llm import toxicity as T

BAD = ["blarg", "snotling", "grumbix"]


def corpus(r, n):
    sy = ["ta", "re", "mi", "so", "lu", "ven", "dor", "pla", "ki"]
    vocab = ["".join(r.choice(sy) for _ in range(r.randint(1, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        w = [r.choice(vocab) for _ in range(r.randint(20, 90))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(BAD)
        rows.append((i, " ".join(w).capitalize() + ".", int(bad)))
    return rows, vocab


def test_decoding():
    words = BAD + ["plain", "hello", "looker", "banana"]
    counts = {}
    for w in words:
        s = f"^^{w}$"
        for i in range(len(s) - 2):
            counts[s[i : i + 3]] = counts.get(s[i : i + 3], 0) + 5
    lm = T.LanguageModel(counts)
    for token, want in (("bl4rg", "blarg"), ("b1@rg", "blarg"), ("sn0t1ing", "snotling"), ("blaaaarg", "blarg"), ("b-l-a-r-g", "blarg"), ("grum8ix", "grumbix"), ("$notling", "snotling")):
        assert want in T.restore(token, lm), (token, T.restore(token, lm))
    assert T.restore("plain", lm) == ["plain"] and T.restore("plain%%%", lm) == ["plain"] and T.restore("12,5", lm) == []
    assert T.spaced_out("he is a b l a r g today") == ["ablarg"] or "blarg" in T.spaced_out("he is b l a r g today")
    assert T.restore("9" * 5000, lm) == [] and len(T.decode("a1" * 3000, lm)) > 0


def small_model(words):
    counts = {}
    for w in words:
        s = f"^^{w}$"
        for i in range(len(s) - 2):
            counts[s[i : i + 3]] = counts.get(s[i : i + 3], 0) + 5
    return T.LanguageModel(counts)


def test_spaced_runs_are_split_into_words():
    lm = small_model(BAD + ["plain", "hello", "looker", "banana", "a", "y", "zob", "idiot", "scum", "you", "asset", "are"])
    for text, want in (
        ("a b l a r g", "blarg"), ("he is a b l a r g today", "blarg"), ("y s c u m", "scum"), ("i d i o t s c u m", "idiot"), ("i d i o t s c u m", "scum"),
        ("b  l  a  r  g", "blarg"), ("b\tl\ta\tr\tg", "blarg"), ("b\nl\na\nr\ng", "blarg"), ("say (b l a r g) now", "blarg"), ('"b l a r g"', "blarg"),
        ("a z o b", "zob"), ("z o b", "zob"), ("s n o t l i i n g", "snotling"), ("bb l a rr g", "blarg"), ("b l @ r g", "blarg"), ("$ c u m", "scum"),
        ("b. l. a. r. g", "blarg"), ("s c u m a b l a r g y", "blarg"),
    ):
        assert want in T.spaced_out(text, lm), (text, T.spaced_out(text, lm))
    assert T.spaced_out("you are a person", lm) == [] and T.spaced_out("1 2 3 4 5", lm) == []
    assert "set" not in T.spaced_out("a s s e t", lm)
    assert len(T.spaced_out("b l a r g " * 3000, lm)) >= 3000
    for token, want in (("blaarg", "blarg"), ("iddiot", "idiot"), ("sccum", "scum")):
        assert want in T.restore(token, lm), token


def test_heads_leave_out_no_feature():
    words = BAD + ["idiot", "asset", "aab", "plain", "iddiott", "bblarg", "blaargs", "aabc", "snnotling", "b", "aa"]
    a = T.Scorer(small_model(words[:6]), {f: 1.0 for w in (*BAD, "idiot", "aab") for f in T.features(w)})
    b = T.Scorer(a.lm)
    b.learn(a.weight)
    assert b.heads is not None and all(set(a.token(w)[1]) == set(b.token(w)[1]) for w in words) and a.token("iddiott")[1]


def test_trigrams_of_every_token_are_kept_whole(spark):
    texts = ['"alpha," beta!! (gam-ma)', "alpha. \u4f60\u597d\u5417, \U00020000\U00020001!", "", "12 -- 3x"]
    lm = T.LanguageModel(T.trigram_tables(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)))
    want = {}
    for w, k in (("alpha", 2), ("beta", 1), ("gam", 1), ("ma", 1), ("\u4f60\u597d\u5417", 1), ("\U00020000\U00020001", 1), ("x", 1)):
        s = f"^^{w}$"
        for i in range(len(s) - 2):
            want[s[i : i + 3]] = want.get(s[i : i + 3], 0) + k
    same = T.LanguageModel(want)
    for (k, n), (k2, n2) in zip(lm.tables, same.tables):
        assert k.tolist() == k2.tolist() and n.tolist() == n2.tolist()
    assert lm.count(0, "alp") == 2 and lm.count(1, "^^") == sum(n for g, n in want.items() if g[:2] == "^^") and lm.total == sum(want.values())
    # More distinct trigrams than the 200,000 that were kept once.
    many = spark.createDataFrame([(chr(0x4E00 + i % 300) + chr(0x5E00 + i // 300) + chr(0x6E00 + i % 299) + "!",) for i in range(89_700)], "text string")
    assert len(T.trigram_tables(many)[0][0]) > 250_000


def test_held_out_accuracy_and_obfuscation(spark):
    r = random.Random(3)
    rows, vocab = corpus(r, 600)
    extra = [(1000, " ".join(vocab[:60] + ["bl4rg", "gr-u-m-b-i-x", "sn0tling"])), (1001, " ".join(vocab[:60])), (1002, None), (1003, ""), (1004, "b l a r g " * 30)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(i, t, "x") for i, t in extra], "doc_id long, text string, score string").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = {x["doc_id"]: x for x in T.score_toxicity(docs, labels, fold).collect()}
    assert len(got) == 605
    held = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert sum(p == y for p, y in held) >= 0.99 * len(held)
    assert got[1000]["predicted"] == 1 and got[1004]["predicted"] == 1
    assert got[1001]["predicted"] == got[1002]["predicted"] == got[1003]["predicted"] == 0
    assert all(0 <= x["score"] <= 1 for x in got.values())
    assert T.score_toxicity(docs.limit(0), labels, fold).collect() == []


def test_long_runs_take_linear_time():
    import time

    words = ["blarg", "hello", "there", "world", "stone", "grand"]
    counts = {}
    for w in words * 50:
        z = f"^^{w}$"
        for i in range(len(z) - 2):
            counts[z[i : i + 3]] = counts.get(z[i : i + 3], 0) + 1
    lm = T.LanguageModel(counts)
    for run in ("a " * 20_000, "! " * 10_000 + "a b c", "b l a r g " * 2000, "! ! ! x " * 5000):
        began = time.process_time()
        got = T.spaced_out(run, lm)
        assert time.process_time() - began < 8 and len(got) < 30 * len(run)
    assert "blarg" in T.spaced_out("b l a r g " * 500, lm)
    assert "blarg" in T.spaced_out("you a b l a r g person", lm)
