import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from prepframe.llm import repair as R

SPACE = " \t\n\x0b\x0c\r"


def least(rows, start=0, goals=(0, 3), tail=True):
    """All audits by dynamic programming over whole strings, at most three inserts at a row."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, q, inserts):
        out = [(0, "")] if i == len(rows) and q in goals else []

        def go(letter, w, to):
            if to is not None:
                c, a = to
                out.append((c + w, letter + a))

        if inserts < 4 and (i < len(rows) or tail):
            for c in "ua":
                if (q, c) in step:
                    go("I", 3, best(i, step[q, c], inserts + 1))
        if i < len(rows):
            own, gone, extra = rows[i]
            go("D", 4, best(i + 1, q, 0))
            if not gone:
                if (q, own) in step:
                    go("K", extra, best(i + 1, step[q, own], 0))
                for c in "ua":
                    if (q, c) in step:
                        go("R", 3 + extra, best(i + 1, step[q, c], 0))
        return min(out) if out else None

    return best(0, start, 0)


def test_cheapest_against_all_paths():
    r = random.Random(5)
    for _ in range(4000):
        rows = [(r.choice(["s", "u", "a", "t", "", " "][: r.choice([3, 6])]), r.random() < 0.2, r.choice([0, 0, 3])) for _ in range(r.randint(0, 9))]
        assert R.cheapest(rows) == least(rows), rows
    for _ in range(1500):
        rows = [(r.choice("sua"), r.random() < 0.2, r.choice([0, 3])) for _ in range(r.randint(1, 6))]
        a, z = r.randrange(4), r.randrange(4)
        assert R.cheapest(rows, a, (z,), False) == least(tuple(rows), a, (z,), False)


def expected(rows):
    """The contract, row by row in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        conv_s, turn_s = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        out = convs.setdefault(conv, [])
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        out += [(turn, role, text)] * (2 if d == 3 else 1)
    result = []
    for conv, got in convs.items():
        got.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
        blank = dup = cut = 0
        seen, lattice = set(), []
        for _, role, text in got:
            body = text.strip(SPACE)
            again, odd = (role, text) in seen, bool(body) and body[-1] not in ".!?"
            seen.add((role, text))
            blank, dup, cut = blank + (not body), dup + (bool(body) and again), cut + (odd and not again)
            lattice.append((role[:1], not body or again, 3 if odd else 0))
        ini = [x[0] for x in lattice]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:]))
        turns = [t[0] for t in got if t[0] is not None]
        cost, audit = (R.cheapest(lattice) if len(lattice) > 12 else least(tuple(lattice))) if got else (0, "")
        lines = R.written([t[1:] for t in got], audit)
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        result.append((conv, gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=repr)


def sample(seed):
    r = random.Random(seed)
    texts = ["Yes.", "Why? No", "  ", "", None, "Ok!\n", "a", "né.", "x ", " ", "end. "]
    rows = [(c, t * r.choice([1, 1, 2]), r.choice(["system", "user", "assistant", "user", "assistant", None, "tool", "", "Xu"]), r.choice(texts))
            for c in range(60) for t in range(r.randint(1, 8))]
    rows += [(None, t, r.choice(["user", "assistant"]), r.choice(texts)) for t in range(9)]
    rows += [(700, None, "user", "Hi."), (700, None, "assistant", "Hi."), (701, 1, "user", "Same."), (701, 1, "user", "Same.")]
    rows += [(800, t, "user" if t % 2 else "assistant", f"{r.choice(texts)} {r.randrange(40)}" + r.choice([".", ""])) for t in range(150)]
    rows += [(900 + c, 0, "user", "gone") for c in range(40)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [1024, 7, 2])
def test_conversations(spark, piece):
    rows = sample(piece)
    df = spark.createDataFrame([(*x, "mark", 1) for x in rows], "conv_id long, turn long, role string, text string, mark string, copy int").repartition(3)
    got = R.repair(R.damage(df), piece_rows=piece).collect()
    assert sorted((tuple(g) for g in got), key=repr) == expected(rows)


def test_text_ids_and_empty(spark):
    df = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert sorted((tuple(g) for g in R.repair(R.damage(df)).collect()), key=repr) == expected([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")])
    assert R.repair(R.damage(df.limit(0))).collect() == []


def test_long_conversation_is_linear():
    import time

    rows = [("u", k % 3 == 0, 3 * (k % 2)) for k in range(20_000)]
    began = time.process_time()
    cost, audit = R.cheapest(rows)
    assert time.process_time() - began < 10 and len(audit) >= len(rows)
