import re

from prepframe.llm import quality as Q


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    cover = {i + k for i, x in enumerate(tri) if tri.count(x) > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


GOOD = " ".join(f"word{i} runs" for i in range(40))
TEXTS = [
    GOOD, None, "", "  \n\t ", "a b c a b c", "a a a a", "x y\nx y\n\nx y", "été à\x0bb\x0cc\r\nd", "one two three one two three four five one two",
    GOOD + " ### $$$ %%% ### $$$ %%% ### $$$ %%% ### $$$", "\n".join(["same line"] * 9 + [GOOD]), GOOD.upper(), " ".join(x + "!!" for x in GOOD.split()),
    " ".join(str(i * 7919) for i in range(60)), " ".join(f"w{i} w{i}" for i in range(40)), "z" * 9000 + " " + GOOD, "\x85 \xa0",
]


def test_measures_and_verdicts(spark):
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, words string").repartition(3)
    got = {r["doc_id"]: r for r in Q.apply_cascade(df).collect()}
    for i, t in enumerate(TEXTS):
        assert tuple(got[i][c] for c in Q.BASE_COLUMNS) == brute(t), t
        n, _, _, _, rep = brute(t)
        assert got[i]["base_failed"] == (n < 50 or 100 * rep > 50 * n)
    assert {i for i in got if got[i]["kept"]} == {0}
    assert {got[i]["rejected_by"] for i in (9, 11, 12, 13, 14)} <= {"symbols", "shouting", "exclaiming", "no_letters", "echo"}


def test_letters_of_all_scripts(spark):
    stems = ["λόγος", "слово", "كلمة", "מילה", "शब्द", "단어는", "բառեր", "คำพูด"]
    texts = [" ".join(f"{w}{i} {w}" for i in range(40)) for w in stems]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, " ".join(f"{i * 7919}" for i in range(60)))], "doc_id long, text string")
    got = {r["doc_id"]: r["rejected_by"] for r in Q.apply_cascade(df).collect()}
    assert got[99] == "no_letters" and all(got[i] is None for i in range(len(texts))), got


def test_order_does_not_change_verdicts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + TEXTS)], "doc_id long, text string")
    m = Q.base_measures(df)
    rows = {}
    for rules in (Q.RULES, Q.RULES[::-1]):
        rows[rules[0].name] = sorted(m.withColumn("r", Q.cascade(rules).isNull()).select("doc_id", "r").collect())
    assert len(set(map(str, rows.values()))) == 1
    assert sorted(r.name for r in Q.plan_cascade(m, sample_rows=5)) == sorted(r.name for r in Q.RULES)
    assert Q.apply_cascade(df.limit(0)).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = Q.apply_cascade(df).where("kept")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_greedy_order_counts_what_is_left():
    # Rule 1 rejects most rows but rule 0 rejects the same ones for less; rule 2 has rows of its own.
    masks = {0b011: 60, 0b010: 5, 0b100: 20, 0: 100}
    assert Q.greedy_order(masks, [1.0, 1.0, 1.0]) == [1, 2, 0]
    assert Q.greedy_order(masks, [0.5, 1.0, 1.0]) == [0, 2, 1]
    assert Q.greedy_order({}, [1.0, 0.5]) == [1, 0] and Q.greedy_order({0: 9}, []) == []


def test_sample_is_drawn_from_all_partitions(spark):
    df = spark.range(40_000).selectExpr("id AS doc_id", "'same text' AS text").repartition(8, "doc_id")
    got = [r["doc_id"] for r in Q.sample_of(df, 2000).collect()]
    assert 1700 < len(got) < 2300 and len({i // 10_000 for i in got}) == 4
    assert Q.sample_of(df.limit(5), 2000).count() == 5 and Q.sample_of(df.limit(0), 2000).count() == 0
    order = Q.plan_cascade(spark.createDataFrame([(t,) for t in TEXTS], "text string"))
    assert sorted(r.name for r in order) == sorted(r.name for r in Q.RULES)
