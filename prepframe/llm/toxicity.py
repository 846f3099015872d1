"""Operator 2: toxicity after noisy-channel deobfuscation.

1. A character trigram model is counted from the letter runs of all texts (a shuffle over
   the corpus vocabulary, whose size follows the input).  All trigrams are kept, as sorted
   arrays of 16 bytes an entry; their number is bounded by the alphabets, not by the rows.
2. Tokens that look written over (digits or signs among letters, repeated letters) become a
   lattice: every sign may stand for the letters it resembles or be a separator to drop, and
   a repeated letter may be one letter.  Viterbi finds the most probable word under channel
   and language model.  A run of single letters with any white space or signs between is one
   lattice, too, in which every gap may also end a word; all words on segmentations close to
   the best one count.
3. Weights of restored words and word beginnings come from labelled training texts; a
   logistic curve over a text's summed weights gives the score.

The fit reads at most ``max_rows`` labelled texts of each class (by a hash of the id);
their ids are the only thing broadcast.  Scoring covers every whole text.

Edge cases: null and empty texts have no words and get the lowest score; null labels are
ignored; with one class only in the training rows every score is 0; repeated rows are
scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import map_batches, prepare

MAX_FIT_ROWS = 8_000
MAX_FEATURES = 5_000
MIN_SURPRISE = 30.0  # about one chance in 10 million
CACHE = 300_000

# Signs and the letters they commonly stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SWAP, DROP, FOLD = math.log(0.2), math.log(0.05), math.log(0.3)
LONGEST = 32  # letters of a word inside a spaced run, with a gap after each
NEAR = math.log(1000)  # segmentations of a spaced run at most so much less probable than the best one count

EDGES = ".,;:?\"'’()[]{}<>#%&*~^=/\\-_"
_LETTERS = re.compile(r"[^\W\d_]+")
_SIGN = "[" + re.escape("".join(c for c in LOOKS_LIKE if not c.isalnum())) + "]"
# Three or more single (or repeated) letters or digits, white space or signs between them.
_SPACED = re.compile(rf"(?<![^\W_])([^\W_])\1*[\W_]+([^\W_])\2*[\W_]+([^\W_])\3*(?![^\W_])(?:[\W_]+([^\W_])\4*(?![^\W_]))*(?:\s+{_SIGN}(?!\S))*")
_SIGNS = frozenset(c for c in LOOKS_LIKE if not c.isalnum())
_GAP = re.compile(r"\s+|[^\w\s]|_")
_DOUBLED = re.compile(r"([^\W\d_])\1")
_WRITTEN_OVER = re.compile(r"[^\W\d_][^\w\s'’,.;:]*[0-9@$!|+(<€£¡*._-]+[^\W\d_]|[0-9@$!|¡€£][^\W\d_]|[^\W\d_][0-9@$€£](?![@$€£])|([^\W\d_])\1")


PLACE = 21  # bits of a code point


def _key(text: str) -> int:
    """Up to three letters as one number."""
    out = 0
    for c in text:
        out = out << PLACE | ord(c)
    return out


def _total(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    keys, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, n)
    return keys, out


class LanguageModel:
    """Interpolated character trigrams with word borders.

    ``counts`` is a dict of trigrams, or the tables (sorted keys, counts) of whole trigrams,
    their first two letters, last two letters, middle letter and last letter.
    """

    def __init__(self, counts: dict[str, int] | list[tuple[np.ndarray, np.ndarray]]):
        if isinstance(counts, dict):
            keys = np.array([_key(k) for k in counts], np.int64)
            n = np.array(list(counts.values()), np.int64)
            low = (1 << PLACE) - 1
            parts = (keys, keys >> PLACE, keys & (low << PLACE | low), keys >> PLACE & low, keys & low)
            counts = [_total(k, n) for k in parts]
        self.tables = counts
        self.total = int(counts[4][1].sum()) or 1
        self.known: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"known": {}}

    def count(self, table: int, text: str) -> int:
        keys, n = self.tables[table]
        k = _key(text)
        at = keys.searchsorted(k)
        return int(n[at]) if at < len(keys) and keys[at] == k else 0

    def logp(self, before: str, c: str) -> float:
        got = self.known.get(before + c)
        if got is None:
            a = self.count(0, before + c) / max(1, self.count(1, before))
            b = self.count(2, before[1] + c) / max(1, self.count(3, before[1]))
            u = (self.count(4, c) + 0.5) / (self.total + 50)
            if len(self.known) > CACHE:
                self.known.clear()
            got = self.known[before + c] = math.log(0.7 * a + 0.25 * b + 0.05 * u)
        return got


def decode(token: str, lm: LanguageModel) -> str:
    """Most probable word behind a written-over token (Viterbi over the last two letters)."""
    best = {"^^": (0.0, "")}
    last = ""
    for ch in token:
        nxt: dict[str, tuple[float, str]] = {}
        letters = [(ch, 0.0)] if ch.isalpha() else [(x, SWAP) for x in LOOKS_LIKE.get(ch, "")]
        skip = None if ch.isalpha() else DROP
        if ch == last and ch.isalpha():
            skip = FOLD
        if skip is None and len(best) == 1:  # one way only
            ((state, (score, word)),) = best.items()
            best, last = {state[1] + ch: (score + lm.logp(state, ch), word + ch)}, ch
            continue
        for state, (score, word) in best.items():
            for x, cost in letters:
                s, key = score + cost + lm.logp(state, x), state[1] + x
                if key not in nxt or s > nxt[key][0]:
                    nxt[key] = (s, word + x)
            if skip is not None and (state not in nxt or score + skip > nxt[state][0]):
                nxt[state] = (score + skip, word)
        best, last = nxt or best, ch
    return max(((s + lm.logp(k, "$"), w) for k, (s, w) in best.items()), default=(0.0, ""))[1]


def restore(token: str, lm: LanguageModel) -> list[str]:
    """The words behind one white-space token, lower case."""
    if token.isalpha():
        return [decode(token, lm), token] if _DOUBLED.search(token) else [token]
    core = token.strip(EDGES).rstrip("!|")
    if not _WRITTEN_OVER.search(core):
        return [core] if core.isalpha() else _LETTERS.findall(core)
    return [decode(core, lm), *_LETTERS.findall(core)]


def split_run(run: str, lm: LanguageModel) -> list[str]:
    """Words of all segmentations of a spaced run that come close to the most probable one.

    Forward and backward Viterbi over (place, last two letters) give the best score through
    every word border; words are then spelt from the likely borders only, each word once a
    border, over at most 2 * LONGEST signs and gaps.  The time is linear in the run.
    """
    steps: list[tuple[list[tuple[str, float]], float | None]] = []  # letters and the cost of none; no letters: a gap
    last = ""
    for m in re.finditer(r"\s+|.", run, re.S):
        ch = m[0]
        if ch.isspace() or (not ch.isalnum() and ch not in LOOKS_LIKE):
            steps.append(([], None))
            continue
        letters = [(ch, 0.0)] if ch.isalpha() else [(x, SWAP) for x in LOOKS_LIKE.get(ch, "")]
        steps.append((letters, (FOLD if ch == last else None) if ch.isalpha() else DROP))
        last = ch

    def moves(step, state):
        letters, skip = step
        if not letters and skip is None:  # a gap is dropped, or ends a word
            yield state, "", 0.0
            if state != "^^":
                yield "^^", " ", lm.logp(state, "$")
            return
        for x, cost in letters:
            yield state[1] + x, x, cost + lm.logp(state, x)
        if skip is not None:
            yield state, "", skip

    ahead = [{"^^": 0.0}]
    for step in steps:
        nxt: dict[str, float] = {}
        for state, score in ahead[-1].items():
            for to, _, cost in moves(step, state):
                nxt[to] = max(nxt.get(to, -math.inf), score + cost)
        ahead.append(nxt)
    rest = [{s: 0.0 if s == "^^" else lm.logp(s, "$") for s in ahead[-1]}]
    for step, states in zip(reversed(steps), reversed(ahead[:-1])):
        rest.append({s: max((cost + rest[-1][to] for to, _, cost in moves(step, s)), default=-math.inf) for s in states})
    rest.reverse()
    least = rest[0]["^^"] - NEAR
    words: list[str] = []
    for start, states in enumerate(ahead[:-1]):
        # A word starts at the run's start and after a gap.
        if (start and steps[start - 1] != ([], None)) or states.get("^^", -math.inf) + rest[start].get("^^", -math.inf) < least:
            continue
        live, found = {"^^": (states["^^"], "")}, set()
        for at in range(start, min(len(steps), start + 2 * LONGEST)):
            nxt_words: dict[str, tuple[float, str]] = {}
            for state, (score, word) in live.items():
                if at > start and not word and steps[at] == ([], None):  # begins behind the gap
                    continue
                for to, x, cost in moves(steps[at], state):
                    if score + cost + rest[at + 1][to] < least:
                        continue
                    if x == " ":
                        found.add(word)
                    elif to not in nxt_words or score + cost > nxt_words[to][0]:
                        nxt_words[to] = (score + cost, word + x)
            live = nxt_words
            if not live:
                break
        else:
            if start + 2 * LONGEST >= len(steps):
                found.update(word for _, word in live.values() if word)
        words += sorted(found)
    return words


def signs_before(text: str, low: int, start: int) -> int:
    """Where the single signs begin that stand right before ``start``, one by one, not before ``low``."""
    at = start
    while True:
        j = at
        while j > low and text[j - 1].isspace():
            j -= 1
        if j == at or j == low or text[j - 1] not in _SIGNS or (j > 1 and not text[j - 2].isspace()):
            return at
        at = j - 1


def spaced_out(text: str, lm: LanguageModel | None = None) -> list[str]:
    """Words of the runs of three or more single letters; without a model each run in one piece."""
    runs, end = [], 0
    for m in _SPACED.finditer(text):
        run, end = text[signs_before(text, end, m.start()) : m.end()], m.end()
        if any(c.isspace() for c in run) and any(c.isalpha() for c in run):
            runs.append(run)
    if lm is None:
        return [_GAP.sub("", r) for r in runs]
    return [w for r in runs for w in split_run(r, lm)]


def features(word: str) -> list[str]:
    return [word] + [word[:k] + "~" for k in (4, 5, 6) if len(word) > k]


def head(word: str) -> str:
    """The first two letters that differ: folding repeated letters leaves them alike."""
    i = 1
    while word[i : i + 1] == word[0]:
        i += 1
    return word[0] + word[i : i + 1]


@dataclass
class Scorer:
    """Weights of words and word beginnings, and a logistic curve over a text's evidence."""

    lm: LanguageModel
    weight: dict[str, float] = field(default_factory=dict)
    slope: tuple[float, ...] = (0.0, 0.0)
    shift: float = -30.0
    cache: dict = field(default_factory=dict)
    heads: set[str] | None = None  # heads of all features; a token of letters with another one has none of them

    def learn(self, weight: dict[str, float]) -> None:
        heads = {head(f.rstrip("~")) for f in weight}
        self.weight, self.heads, self.cache = weight, None if any(len(h) < 2 for h in heads) else heads, {}

    def token(self, t: str) -> tuple:
        """Largest weight and known features of a white-space token's restored words."""
        got = self.cache.get(t)
        if got is None:
            if self.heads is not None and t.isalpha() and head(t) not in self.heads:
                return 0.0, ()
            if len(self.cache) > CACHE:
                self.cache.clear()
            known = {f for w in restore(t, self.lm) for f in features(w) if f in self.weight}
            got = self.cache[t] = (max((self.weight[f] for f in known), default=0.0), known)
        return got

    def evidence(self, text: str) -> tuple[float, float]:
        """Summed weight of the distinct features, and weight per hundred words."""
        low = text.lower()
        words = low.split()
        found: set = set()
        dense = 0.0
        for t, n in Counter([*words, *spaced_out(low, self.lm)]).items():
            w, known = self.cache.get(t) or self.token(t)
            if known:
                dense += w * n
                found |= known
        return math.log1p(sum(self.weight[f] for f in found)), math.log1p(100 * dense / max(1, len(words)))

    def score(self, text: str) -> float:
        z = sum(a * x for a, x in zip(self.slope, self.evidence(text))) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def trigram_tables(docs: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Character trigrams over the letter runs of all texts, weighted by run frequency
    (damped), and the sums a ``LanguageModel`` takes from them."""

    def words(batches):
        def runs():
            out: Counter = Counter()
            for t, n in seen.items():
                if t.isalpha():
                    out[t] += n
                else:
                    for w in _LETTERS.findall(t):
                        out[w] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], names=["w", "n"])

        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(t.lower().split())
            if len(seen) > CACHE:
                yield runs()
        if seen:
            yield runs()

    def grams(b: pa.RecordBatch):
        out: Counter = Counter()
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            k, s = 1 + int(math.log2(n)), f"^^{w}$"
            for i in range(len(s) - 2):
                out[s[i : i + 3]] += k
        return pa.RecordBatch.from_arrays([pa.array([_key(g) for g in out], pa.int64()), pa.array(list(out.values()), pa.int64())], names=["g", "n"])

    vocabulary = docs.select("text").mapInArrow(words, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    table = map_batches(vocabulary, grams, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    g, low = F.col("g"), (1 << PLACE) - 1
    middle = F.shiftright("g", PLACE)
    parts = (g, middle, g.bitwiseAND(F.lit(low << PLACE | low)), middle.bitwiseAND(F.lit(low)), g.bitwiseAND(F.lit(low)))
    every = table.select(F.explode(F.array(*(F.struct(F.lit(i).alias("t"), p.cast("long").alias("k")) for i, p in enumerate(parts)))).alias("p"), "n")
    # All distinct trigrams: numbers in Arrow batches, bounded by the alphabets of the texts.
    got = every.groupBy("p.t", "p.k").agg(F.sum("n").alias("n")).toArrow()
    t, k, n = (got.column(i).to_numpy() for i in range(3))
    return [_total(k[t == i], n[t == i]) for i in range(5)]


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", max_rows: int = MAX_FIT_ROWS) -> Scorer:
    """Scorer learnt from (doc_id, text) and the labels outside ``held_out``."""
    scorer = Scorer(LanguageModel(trigram_tables(docs)))
    usable = labels.where(F.col(label).isin(0, 1) & ~held_out).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(max_rows) for y in (0, 1)]
    picked = chosen[0].union(chosen[1])  # at most 2 * max_rows rows of (id, label)
    texts = docs.join(F.broadcast(picked), "doc_id").select("text", F.col("y").cast("int").alias("y")).dropDuplicates(["text"])
    lm = scorer.lm

    def count(b: pa.RecordBatch):
        out: Counter = Counter()
        for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            low = t.lower()
            words = {w for x in set(low.split()) for w in restore(x, lm)} | {w for x in spaced_out(low, lm) for w in restore(x, lm)}
            out.update((f, y) for f in {f for w in words if w for f in features(w)})
            out[("", y)] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in out]), pa.array([k[1] for k in out], pa.int32()), pa.array(list(out.values()), pa.int64())],
            names=["f", "y", "n"],
        )

    table = map_batches(texts, count, "f string, y int, n long").groupBy("f").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c")
    )
    table = table.persist()
    totals = table.where("f = ''").collect()  # one row
    nt, nc = (totals[0]["t"], totals[0]["c"]) if totals else (0, 0)
    if not nt or not nc:
        table.unpersist()
        return scorer
    ratio = F.log((F.col("t") + 0.5) / (nt + 1.0)) - F.log((F.col("c") + 0.5) / (nc + 1.0))
    # Log-likelihood ratio against independence: chance words of a few texts do not count.
    share, n = nt / (nt + nc), F.col("t") + F.col("c")
    surprise = 2 * (F.col("t") * F.log(F.col("t") / (n * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - share)))).otherwise(0.0))
    best = table.where((F.col("f") != "") & (F.col("t") > 0)).select("f", ratio.alias("w"), surprise.alias("g"))
    best = best.where((F.col("w") > 1.5) & (F.col("g") > MIN_SURPRISE))
    rows = best.orderBy(F.desc("g"), "f").limit(MAX_FEATURES).collect()  # limit: MAX_FEATURES rows
    table.unpersist()
    scorer.learn({r["f"]: r["w"] for r in rows})

    def evidence(b: pa.RecordBatch):
        rows = [scorer.evidence(t) for t in b.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), b.column(1)], names=["x1", "x2", "y"]
        )

    got = map_batches(texts, evidence, "x1 double, x2 double, y int").collect()  # at most 2 * max_rows rows of numbers
    x, y = np.array([[r["x1"], r["x2"], 1.0] for r in got]), np.array([r["y"] for r in got])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))  # classes weigh the same
    w = np.zeros(3)
    for _ in range(25):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
        w = w - np.linalg.solve(hess, x.T @ (weight * (p - y)) + 1e-4 * w)
    scorer.slope, scorer.shift, scorer.cache = (float(w[0]), float(w[1])), float(w[2]), {}
    return scorer


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", threshold: float = 0.7,
    max_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``held_out`` is an expression over doc_id."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scorer = fit(docs, labels.select(F.col(id_col).alias("doc_id"), label), held_out, label, max_rows)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([scorer.score(t) for t in b.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    scored = map_batches(docs, fn, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.7, max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    scorer = fit(texts, labels.select("doc_id", label), F.lit(False), label, max_rows)
    at = docs.columns.index("text")

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array([scorer.score(t or "") < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, fn, docs.schema)
