import random
import re

from prepframe.llm.jaccard import similarity_components


def brute(rows, width, percent):
    sets = []
    for i, (_, t) in enumerate(rows):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    comp = {}
    for i in range(len(rows)):
        comp[find(i)] = min(comp.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), comp[find(i)]) for i in range(len(rows)))


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = " ".join(r.choice(vocab) for _ in range(30))
    texts = []
    for _ in range(40):
        base = [r.choice(vocab) for _ in range(r.randint(5, 120))]
        texts.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 6])):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            texts.append(" ".join(copy) if r.random() < 0.7 else " ".join(copy).upper())
        texts.append(line + " " + " ".join(r.choice(vocab) for _ in range(r.randint(0, 4))))
    return texts + ["", None, " \n\t", "one", "ONE", "one two", "a b c d", "É é x"]


def test_components_equal_brute_force(spark):
    for seed, move in ((1, 3), (2, 24)):
        rows = list(enumerate(corpus(seed)))
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, comp string").repartition(5)
        got = sorted(tuple(x) for x in similarity_components(df, move_above=move).collect())
        assert got == brute(rows, 3, 90)
    got = sorted(tuple(x) for x in similarity_components(df, width=5, percent=80).collect())
    assert got == brute(rows, 5, 80)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (7, "A b c d"), (9, None)], "doc_id long, text string")
    got = sorted(tuple(x) for x in similarity_components(df).collect())
    assert got == [(5, 2, 5), (5, 2, 5), (7, 2, 5), (9, 0, 9)]
    assert similarity_components(df.limit(0)).collect() == []


def family(seed, with_base):
    """One text copied many times with edits, so that copies lie on both sides of the threshold, and copies of copies."""
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(300)]
    base = [r.choice(vocab) for _ in range(90)]
    texts = [" ".join(base)] if with_base else []
    for k in range(150):
        copy = list(base)
        for _ in range(r.randint(1, 7)):
            copy[r.randrange(len(copy))] = r.choice(vocab)
        if r.random() < 0.3:
            del copy[: r.randint(0, 12)]
        texts.append(" ".join(copy))
        if k % 10 == 0:
            for _ in range(4):
                again = list(copy)
                again[r.randrange(len(again))] = r.choice(vocab)
                texts.append(" ".join(again))
    return texts


def test_family_on_both_sides_of_the_threshold(spark):
    for seed, with_base, width, percent, above in ((3, True, 5, 80, 24), (4, False, 3, 90, 8)):
        rows = list(enumerate(family(seed, with_base) + corpus(seed)[:60]))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = sorted(tuple(x) for x in similarity_components(df, width=width, percent=percent, move_above=above).collect())
        assert got == brute(rows, width, percent)


def test_far_members_of_a_family_do_not_meet(spark):
    from prepframe.llm import jaccard as J

    rows = list(enumerate(family(5, True)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    met = []
    real = J._open_pairs

    def counted(*a):
        out = real(*a).persist()
        met.append(out.count())
        return out

    J._open_pairs = counted
    try:
        got = sorted(tuple(x) for x in similarity_components(df, move_above=8).collect())
    finally:
        J._open_pairs = real
    assert got == brute(rows, 3, 90) and sum(met) < 0.1 * len(rows) ** 2 / 2


def test_histograms_never_exclude_a_link():
    import numpy as np

    from prepframe.llm import jaccard as J

    r = np.random.RandomState(1)
    excluded = 0
    for _ in range(1500):
        n = int(r.choice([1, 2, 5, 60, 127, 128, 129, 700]))
        x = np.unique(r.randint(0, 2**63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2))
        if r.rand() < 0.2:
            x = np.unique(x >> np.uint64(56))  # all hashes in one range
        y = np.unique(np.concatenate([x[r.rand(len(x)) < r.choice([0.5, 0.9, 0.97, 1.0])], r.randint(0, 2**63, int(r.choice([0, 0, 1, 9])), dtype=np.int64).astype(np.uint64)]))
        if len(y):
            both = len(np.intersect1d(x, y))
            link = 100 * both >= 90 * (len(x) + len(y) - both)
            assert J.may_link(J.histogram(x), J.histogram(y), 90) or not link
            excluded += not J.may_link(J.histogram(x), J.histogram(y), 90)
    assert excluded > 300


def test_first_shared_tokens_of_a_link_are_in_reach(spark):
    """Every linked pair is named by the open pairs alone, also where its shared tokens stand late."""
    import numpy as np

    from prepframe.llm import jaccard as J

    r = np.random.RandomState(2)
    sets = []
    for k in range(60):
        s = np.unique(r.randint(0, 2**62, int(r.choice([1, 2, 5, 20, 60])), dtype=np.int64).astype(np.uint64))
        sets += [s, np.unique(np.concatenate([s[r.rand(len(s)) < 0.95], r.randint(0, 2**62, len(s) // 12, dtype=np.int64).astype(np.uint64)]))]
        sets.append(np.unique(np.concatenate([s[len(s) // 9 :], s[:1] + np.uint64(1)])))  # what they share stands behind what they don't
    for percent in (80, 90):
        rows, want = [], set()
        for i, s in enumerate(sets):
            prefix, free, listed = J._one_prefix(s, np.zeros(0, np.uint64), percent, True) if len(s) else (s, 0, 0)
            rows += [(int(t), k, True, i, len(s), listed, i, True) for k, t in enumerate(prefix.astype(np.int64))]
        for i, s in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(s, sets[j]))
                if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                    want.add((j, i))
        groups = spark.createDataFrame(rows, "token long, at int, own boolean, rep long, n long, f long, comp long, probe boolean")
        got = {tuple(x) for x in J._open_pairs(groups, groups, percent).collect()}
        assert want and want <= got, want - got
