"""Operator 3: quality classifier by co-training.

Two views of a document are classified apart by logistic regressions:

* text: shares of neighbouring character classes, and of repeated words,
  neighbours and lines (``text_features``);
* metadata: source and language (hashed to buckets), and length.

Labelled documents train both; a fifth of them (by a hash of the id) is held
out for calibration. In each round every unlabelled document on which one view
is confident (calibrated probability beyond ``confident``) is a pseudo-label
for the other view; ``Model.history`` tells how many each view got and how well it
judged the held-out rows. Both views are then calibrated (Platt, on the held-out
rows) and their log odds added, less the prior's, to score all documents.

Everything is fitted on all rows: a Newton step needs sums over the rows of a
few thousand numbers per task, which tasks add up before the driver sees them.
No row is sampled. The features (about half a kilobyte a document, without
the text) are written once to the shared folder; scoring reads the texts again
and needs no shuffle.

Defined cases: a null or empty text has all shares zero; null metadata have
their own bucket; a document's labels that disagree count by their mean (half
is good); null labels are no labels; labels without a document are ignored;
without both labels every document is scored by the prior (1 if there is no
label at all) and kept; ``mark`` keeps all columns of the input, repeated rows
included; an empty table gives no rows.
"""

from __future__ import annotations

import operator
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.llm.common import batch_column, keep

CONFIDENT, ROUNDS, THRESHOLD, RIDGE, PSEUDO_WEIGHT = 0.95, 3, 0.5, 1.0, 0.5
CLASSES, SOURCES, LANGS, BINS = 7, 32, 16, 240
N_TEXT, N_META = CLASSES * CLASSES + 7, SOURCES + LANGS + 3


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Character class by code point: lower, upper, digit, space, line
    break, plain punctuation, other; all above U+3000 count as lower."""
    out = np.zeros(0x3001, np.uint8)
    for c in range(0x3000):
        kind = unicodedata.category(chr(c))
        out[c] = (4 if chr(c) == "\n" else 1 if kind in ("Lu", "Lt") else 0 if kind[0] in "LM" else 2 if kind[0] == "N"
                  else 3 if kind[0] == "Z" or chr(c) in "\t\r" else 5 if chr(c) in ".,;:'\"-()?" else 6)
    return out


def text_features(text: str) -> np.ndarray:
    out = np.zeros(N_TEXT, np.float32)
    if not text:
        return out
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = _class_table()[np.minimum(code, 0x3000)].astype(np.intp)
    if len(kind) > 1:
        out[:CLASSES * CLASSES] = np.sqrt(np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=CLASSES * CLASSES) / (len(kind) - 1))
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    distinct = len(set(words))
    out[-7:] = (distinct / n, distinct / n ** 0.5 / 10, sum(map(operator.eq, words, words[1:])) / n, min(len(code) / n, 100) / 10,
                np.log1p(len(words)) / 10, len(set(lines)) / len(lines), min(n / len(lines), 200) / 100)
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(N_META, np.float32)
    out[zlib.crc32((source or "\0").encode()) % SOURCES] = 1
    out[SOURCES + zlib.crc32((lang or "\0").encode()) % LANGS] = 1
    size = float(np.log1p(max(n_chars or 0, 0)))
    out[-3:] = (size / 10, size * size / 100, n_chars is None)
    return out


def _meta_rows(batch) -> np.ndarray:
    cols = (batch_column(batch, c).to_pylist() for c in ("source", "lang", "n_chars"))
    return np.array([meta_features(*r) for r in zip(*cols)], dtype=np.float32).reshape(-1, N_META)


def _features(batches):
    for batch in batches:
        x = [text_features(t.as_py()).tobytes() for t in batch_column(batch, "text")]
        m = [r.tobytes() for r in _meta_rows(batch)]
        yield pa.record_batch([batch_column(batch, "doc_id"), pa.array(x, pa.binary()), pa.array(m, pa.binary())], names=["doc_id", "x", "m"])


def _views(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"))


class Model:
    """Weights of the two views, their calibration and the prior."""

    def __init__(self, prior: float, mean, scale):
        self.prior, self.mean, self.scale = prior, mean, scale
        self.w = [np.zeros(n + 1) for n in (N_TEXT, N_META)]
        self.platt = [(1.0, 0.0), (1.0, 0.0)]
        self.trained = False
        self.history: list[dict] = []  # of each round and view: pseudo-labels got, share of held-out rows judged right

    def design(self, x: np.ndarray, view: int) -> np.ndarray:
        z = (x - self.mean[view]) / self.scale[view]
        return np.hstack([z, np.ones((len(z), 1))])

    def margin(self, design: np.ndarray, view: int) -> np.ndarray:
        return design @ self.w[view]

    def odds(self, margin: np.ndarray, view: int) -> np.ndarray:
        a, b = self.platt[view]
        return a * margin + b

    def combined(self, odds_text: np.ndarray, odds_meta: np.ndarray) -> np.ndarray:
        return odds_text + odds_meta - np.log(self.prior / (1 - self.prior))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _rows(batch):
    x = np.frombuffer(b"".join(batch_column(batch, "x").to_pylist()), np.float32).reshape(-1, N_TEXT).astype(np.float64)
    m = np.frombuffer(b"".join(batch_column(batch, "m").to_pylist()), np.float32).reshape(-1, N_META).astype(np.float64)
    y = batch_column(batch, "y").to_numpy(zero_copy_only=False).astype(np.float64)  # NaN: no label
    return x, m, y, batch_column(batch, "held").to_numpy(zero_copy_only=False).astype(bool)


def _sum_moments(batches):
    total = None
    for batch in batches:
        x, m, y, _ = _rows(batch)
        known = y[~np.isnan(y)]
        part = np.concatenate([[len(x), len(known), known.sum()], x.sum(0), (x * x).sum(0), m.sum(0), (m * m).sum(0)])
        total = part if total is None else total + part
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _step_sums(model: Model, pseudo: Model | None):
    """Gradients, Hessians and calibration counts of both views."""
    def run(batches):
        total = None
        for batch in batches:
            x, m, y, held = _rows(batch)
            known = ~np.isnan(y)
            data = (x, m)
            target, weight = [], []
            for view in (0, 1):
                t, w = np.where(known, y, 0.0), (known & ~held).astype(np.float64)
                if pseudo is not None:  # the other view's confident opinions
                    o = 1 - view
                    p = _sigmoid(pseudo.odds(pseudo.margin(pseudo.design(data[o], o), o), o))
                    sure = ~known & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
                    t, w = np.where(sure, p >= 0.5, t), np.where(sure, PSEUDO_WEIGHT, w)
                target.append(t)
                weight.append(w)
            parts = []
            for view in (0, 1):
                d = model.design(data[view], view)
                z = model.margin(d, view)
                p = _sigmoid(z)
                curve = weight[view] * np.maximum(p * (1 - p), 1e-6)
                parts += [d.T @ (weight[view] * (p - target[view])), (d.T @ (d * curve[:, None])).ravel()]
                use = known & held
                at = np.clip(((z[use] + 12) * (BINS / 24)).astype(int), 0, BINS - 1)
                parts += [np.bincount(at, weights=y[use], minlength=BINS), np.bincount(at, weights=1 - y[use], minlength=BINS)]
                parts.append([np.count_nonzero(~known & (weight[view] > 0))])
            part = np.concatenate(parts)
            total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])
    return run


def _add_up(batches):
    total = None
    for batch in batches:
        for b in batch_column(batch, "sums").to_pylist():
            x = np.frombuffer(b)
            total = x if total is None else total + x
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _total(rows: DataFrame, fn) -> np.ndarray | None:
    """Sum of what ``fn`` yields per task; at most 8 rows reach the driver."""
    sums = rows.mapInArrow(fn, "sums binary").repartition(8).mapInArrow(_add_up, "sums binary").collect()
    return sum((np.frombuffer(r.sums) for r in sums), 0.0) if sums else None


def _calibrate(good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Platt scaling on counts by margin bin, with Platt's smoothed targets."""
    n_good, n_bad = good.sum(), bad.sum()
    if not n_good or not n_bad:
        return 1.0, 0.0
    z = (np.arange(BINS) + 0.5) * (24 / BINS) - 12
    t_good, t_bad = (n_good + 1) / (n_good + 2), 1 / (n_bad + 2)
    design, ab = np.stack([z, np.ones(BINS)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(design @ ab)
        grad = design.T @ (good * (p - t_good) + bad * (p - t_bad)) + np.array([1e-3 * (ab[0] - 1), 1e-3 * ab[1]])
        hess = design.T @ (design * ((good + bad) * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        ab = ab - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(round(max(ab[0], 0.0), 9)), float(round(ab[1], 9))


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Fit on all rows of ``docs``; ``labels`` has doc_id and quality."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.avg("quality").alias("mean"))
    rows = _views(docs).mapInArrow(_features, "doc_id long, x binary, m binary")
    rows = rows.join(known, F.col("doc_id") == F.col("l_id"), "left").select(
        "x", "m", F.when(F.col("mean").isNotNull(), (F.col("mean") >= 0.5).cast("double")).alias("y"), (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("held"))
    rows = keep(rows)
    sums = _total(rows, _sum_moments)
    if sums is None or not sums[1]:
        return Model(1 - 1e-6, [0.0, 0.0], [1.0, 1.0])
    n, parts = sums[0], np.split(sums[3:], np.cumsum([N_TEXT, N_TEXT, N_META]))
    mean = [np.round(parts[0] / n, 9), np.round(parts[2] / n, 9)]
    scale = [np.round(np.sqrt(np.maximum(parts[v * 2 + 1] / n - mean[v] ** 2, 1e-6)), 9) for v in (0, 1)]
    good = sums[2] / sums[1]
    model = Model(float(np.clip(good, 1e-6, 1 - 1e-6)), mean, scale)
    if not 0 < good < 1:
        return model
    model.trained = True
    pseudo: Model | None = None
    for turn in range(rounds + 1):
        for _ in range(5 if turn == 0 else 2):
            _newton(model, _total(rows, _step_sums(model, pseudo)))
        _newton(model, _total(rows, _step_sums(model, pseudo)), only_calibrate=True, turn=turn)
        pseudo = Model(model.prior, mean, scale)
        pseudo.w, pseudo.platt = [w.copy() for w in model.w], list(model.platt)
    return model


def _newton(model: Model, sums: np.ndarray, only_calibrate: bool = False, turn: int = 0) -> None:
    at = 0
    for view, n in enumerate((N_TEXT + 1, N_META + 1)):
        grad, hess = sums[at:at + n], sums[at + n:at + n + n * n].reshape(n, n)
        at += n + n * n
        good, bad = sums[at:at + BINS], sums[at + BINS:at + 2 * BINS]
        pseudo = int(sums[at + 2 * BINS])
        at += 2 * BINS + 1
        if only_calibrate:
            a, b = model.platt[view] = _calibrate(good, bad)
            yes = a * ((np.arange(BINS) + 0.5) * (24 / BINS) - 12) + b > 0
            held = good.sum() + bad.sum()
            model.history.append({"round": turn, "view": ("text", "metadata")[view], "pseudo_labels": pseudo,
                                  "held_out": int(held), "right": float((good[yes].sum() + bad[~yes].sum()) / held) if held else None})
            continue
        ridge = np.full(n, RIDGE)
        ridge[-1] = 1e-6
        step = np.linalg.solve(hess + np.diag(ridge), grad + ridge * model.w[view])
        model.w[view] = np.round(model.w[view] - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12)), 9)


def _score(model, threshold: float, extra: list[str]):
    def run(batches):
        m: Model = model.value
        for batch in batches:
            n = batch.num_rows
            if m.trained:
                x = np.array([text_features(t.as_py() or "") for t in batch_column(batch, "__text")], dtype=np.float64).reshape(-1, N_TEXT)
                meta = _meta_rows(pa.record_batch([batch_column(batch, f"__{c}") for c in ("source", "lang", "n_chars")], names=["source", "lang", "n_chars"])).astype(np.float64)
                odds = [m.odds(m.margin(m.design(d, v), v), v) for v, d in ((0, x), (1, meta))]
                p = [_sigmoid(odds[0]), _sigmoid(odds[1]), _sigmoid(m.combined(*odds))]
                good = p[2] >= threshold
            else:
                p, good = [np.full(n, m.prior)] * 3, np.ones(n, bool)
            rest = batch.select(extra)
            yield pa.record_batch([*rest.columns, *(pa.array(np.round(c, 6)) for c in p), pa.array(good)],
                                  names=[*extra, "__p_text", "__p_meta", "__score", "__keep"])
    return run


def mark(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with __p_text, __p_meta, __score, __keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("text").alias("__text"), F.col("source").cast("string").alias("__source"),
                       F.col("lang").cast("string").alias("__lang"), F.col("n_chars").cast("long").alias("__n_chars"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.DoubleType()) for c in ("__p_text", "__p_meta", "__score")), T.StructField("__keep", T.BooleanType())])
    return rows.mapInArrow(_score(shared, threshold, docs.columns), schema)


def judge(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, p_text, p_meta, score, keep."""
    marked = mark(_views(docs), train(docs, labels, rounds), threshold)
    return marked.select("doc_id", F.col("__p_text").alias("p_text"), F.col("__p_meta").alias("p_meta"), F.col("__score").alias("score"), F.col("__keep").alias("keep"))


def good_only(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    return mark(docs, train(docs, labels, rounds), threshold).where("__keep").select(*[F.col(f"`{c}`") for c in docs.columns])
