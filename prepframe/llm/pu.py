"""Operator 8: quality classifier learnt from positives and unlabelled text only.

One pass turns every whole text into a short row of shape statistics.  A logistic model
over their quantile bins is trained with the non-negative unbiased risk

    pi R_p(+) + max(0, R_u(-) - pi R_p(-))

from trusted positives and unlabelled web text; negative labels are never read.  The class
prior pi is estimated from the same two samples: for a scorer that tells positives from
unlabelled text, pi <= U(score >= t) / P(score >= t) for every t, and the smallest such
ratio with a margin for sampling error is taken.  The fit reads bounded samples
(``max_rows`` each, chosen by a hash of the id); scoring covers every text.

Edge cases: a null or empty text has zero statistics and gets a score like any other;
labels that are null are ignored; without positives every score is the neutral 0.5;
repeated rows are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepframe.llm.common import cut_lineage, map_batches, prepare

MAX_FIT_ROWS = 20_000
BINS = 12
FEATURES = [
    "log_words", "word_len", "symbols", "upper", "exclaim", "digits", "commas", "stops", "echo",
    "distinct_words", "distinct_pairs", "repeated_lines", "line_words", "bare_words", "longest_word",
]
_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~=_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_DIGIT = re.compile(r"[0-9]+")


def statistics(text: str) -> list[float]:
    """Shape statistics of a whole text, in the order of FEATURES."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(n)),
        chars / n,
        sum(map(len, _SYMBOL.findall(text))) / n,
        sum(map(len, _UPPER.findall(text))) / chars,
        text.count("!") / n,
        sum(map(len, _DIGIT.findall(text))) / chars,
        text.count(",") / n,
        text.count(".") / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n**0.9,
        len(pairs) / max(1, n - 1),
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        sum(not w.isalnum() for w in words) / n,
        float(np.log1p(max(map(len, words)))),
    ]


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) of every document, one pass over the texts."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [statistics(t) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["doc_id", "stats"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(src.dtypes)["doc_id"]
    return map_batches(src, fn, f"doc_id {kind}, stats array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class PUModel:
    edges: np.ndarray  # (features, bins - 1) quantile edges
    weights: np.ndarray
    bias: float
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        cols = []
        for j, e in enumerate(self.edges):
            k = np.searchsorted(e, x[:, j], side="left")
            cols.append((k[:, None] > np.arange(len(e))).astype(np.float32))  # steps up to the value's bin
        return np.concatenate(cols, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.design(x) @ self.weights + self.bias)


def _descend(grad, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam on a full-batch gradient."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = grad(w.astype(np.float32))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w.astype(np.float32)


def estimate_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Smallest ratio of tails of the unlabelled and the positive scores, with margins."""
    best = 1.0
    for t in np.unique(np.quantile(sp, np.linspace(0, 0.9, 46))):
        p, u = (sp >= t).mean(), (su >= t).mean()
        slack = np.sqrt(1 / len(sp)) + np.sqrt(1 / len(su))
        best = min(best, (u + slack * np.sqrt(max(u * (1 - u), 1e-6))) / max(p, 1e-6))
    return float(np.clip(best, 0.01, 0.999))


def fit_pu(pos: np.ndarray, unl: np.ndarray, steps: int = 300, rate: float = 0.05, l2: float = 1e-3) -> PUModel:
    both = np.concatenate([pos, unl])
    edges = np.stack([np.quantile(both[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) for j in range(both.shape[1])])
    # Rare extremes lie in the outermost quantiles: add edges close to both ends.
    tails = np.stack([np.quantile(both[:, j], [0.005, 0.02, 0.04, 0.96, 0.98, 0.995]) for j in range(both.shape[1])])
    model = PUModel(np.sort(np.concatenate([edges, tails], 1), 1), np.zeros(0), 0.0, 0.5)
    a, b = (np.concatenate([model.design(x), np.ones((len(x), 1), np.float32)], 1) for x in (pos, unl))

    def between(w):
        return -(a.T @ (1 - _sigmoid(a @ w))) / len(a) + (b.T @ _sigmoid(b @ w)) / len(b) + l2 * w

    w = _descend(between, a.shape[1], steps, rate)
    model.prior = pi = estimate_prior(a @ w, b @ w)

    def risk(w):
        p, u = _sigmoid(a @ w), _sigmoid(b @ w)
        positive = -pi * (a.T @ (1 - p)) / len(a)
        negative = (b.T @ u) / len(b) - pi * (a.T @ p) / len(a)
        # logistic loss of calling x negative is log(1 + e^z)
        value = np.logaddexp(0, b @ w).mean() - pi * np.logaddexp(0, a @ w).mean()
        return (positive + negative if value >= 0 else -negative) + l2 * w

    w = _descend(risk, a.shape[1], steps, rate)
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def sampled(df: DataFrame, key: str, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows, chosen by a hash of the key."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(F.lit("fit"), key), F.lit(1_000_000)) < int(1_000_000 * max_rows / n)).limit(max_rows)


def positive_unlabelled(
    docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", max_rows: int = MAX_FIT_ROWS,
    threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, held_out, score, predicted); ``held_out`` is an expression over doc_id."""
    prepare(docs.sparkSession)
    table = cut_lineage(statistics_table(docs, id_col, text_col))
    fold = table.where(~held_out)
    trusted = labels.where(F.col(label) == 1).select(F.col(id_col).alias("doc_id")).where(~held_out).distinct()
    trusted = sampled(trusted, "doc_id", max_rows)
    take = lambda df: np.array([r["stats"] for r in df.select("stats").collect()], float)  # noqa: E731  at most max_rows rows
    pos, unl = take(fold.join(trusted, "doc_id", "left_semi").limit(max_rows)), take(sampled(fold, "doc_id", max_rows))
    if len(pos) and len(unl):
        model = fit_pu(pos, unl)
    else:
        model = PUModel(np.zeros((len(FEATURES), 0)), np.zeros(0), 0.0, 0.5)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        x = np.asarray(b.column(1).flatten()).reshape(b.num_rows, len(FEATURES))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x).astype(float))], names=["doc_id", "score"])

    scored = map_batches(table, fn, f"doc_id {dict(table.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
