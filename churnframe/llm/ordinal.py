"""Operator 10, ordinal cumulative-link regression on graded ratings.

``P(grade >= k) = sigmoid(w.x - theta_k)`` with one weight vector for all
grades and ordered thresholds ``theta_1 < theta_2 < ...``.  ``x`` is hashed
text: the distinct words of the whole document (runs of letters, digits and
bytes above ASCII, in lower case), the first bytes of longer words, and its profile, quantised shares of
character kinds and of distinct words.  The fit uses a bounded sample, at most
``PER_GRADE`` labelled documents of each grade, chosen by hash; scoring covers
every document inside Arrow tasks, with only the weights broadcast.

Defined results: null or empty text has only profile features and is scored
like any text; labels that are null or without a document are not used; with
fewer than two grades in the sample every document gets null grade and
probabilities and is kept; repeated rows get equal results; extra columns are
passed through and take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import bounded_sample, fresh
from churnframe.llm.wordhash import _LOWER, hash_spans, mix, row_word_bounds, slices, text_buffers

BITS = 20
PER_GRADE = 3000
STEMS = (4, 5)
MIN_DF = 4
EPOCHS = 25
BATCH = 64
RATE = 0.4
L1 = 5e-4

#: byte kinds of the profile: every ASCII character that is no letter, digit
#: or space has its own kind
_KIND = np.full(256, 0, np.intp)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 4
_KIND[[9, 10, 11, 12, 13, 32]] = 5
_other = [b for b in range(128) if _KIND[b] == 0]
for _k, _b in enumerate(_other):
    _KIND[_b] = 6 + _k
N_KINDS = 6 + len(_other)
_WORDLIKE = (_KIND >= 1) & (_KIND <= 4)


def _quantise(share: np.ndarray) -> np.ndarray:
    """0 for none, then one step per factor of two from 1/128 up."""
    with np.errstate(divide="ignore"):
        return np.where(share > 0, np.clip(np.floor(np.log2(share)) + 8, 1, 8), 0).astype(np.uint64)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a batch: (row, slot) sorted by row, without repeats."""
    parts = [(at, *_features(part)) for at, part in slices(column)]
    if not parts:
        return np.zeros(0, np.intp), np.zeros(0, np.int32)
    return (np.concatenate([rows + at for at, rows, _ in parts]),
            np.concatenate([slots for _, _, slots in parts]))


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = text_buffers(column)
    n = len(offsets) - 1
    word = _WORDLIKE[raw]
    begin, end = word.copy(), word.copy()
    if len(raw):
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edge = offsets[:-1][offsets[:-1] < len(raw)]
        begin[edge] = word[edge]
        last = offsets[1:][offsets[1:] > 0] - 1
        end[last] = word[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    bounds = row_word_bounds(starts, offsets)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    low, high = _LOWER[raw], rows.astype(np.uint64) << np.uint64(BITS)
    keys = np.unique(high | (hash_spans(low, starts, ends) >> np.uint64(64 - BITS)))
    stems = []
    for k in STEMS:  # words that share a beginning share a slot
        longer = ends - starts > k
        h = hash_spans(low, starts[longer], starts[longer] + k) * np.uint64(2 * k + 1)
        stems.append(np.unique(high[longer] | (mix(h) >> np.uint64(64 - BITS))))
    # profile: share of each kind among the bytes, share of distinct words
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(n), lengths)
    kinds = np.bincount(owner * N_KINDS + _KIND[raw], minlength=n * N_KINDS).reshape(n, N_KINDS)
    share = kinds / np.maximum(lengths, 1)[:, None]
    distinct = np.bincount((keys >> np.uint64(BITS)).astype(np.intp), minlength=n)
    share = np.concatenate([share, (distinct / np.maximum(np.diff(bounds), 1))[:, None]], axis=1)
    names = np.arange(share.shape[1], dtype=np.uint64)[None, :]
    profile = mix((_quantise(share) << np.uint64(32)) + names + np.uint64(1)) >> np.uint64(64 - BITS)
    tags = (np.arange(n, dtype=np.uint64)[:, None] << np.uint64(BITS)) | profile
    keys = np.unique(np.concatenate([keys, *stems, tags.ravel()]))
    return (keys >> np.uint64(BITS)).astype(np.intp), (keys & np.uint64((1 << BITS) - 1)).astype(np.int32)


#: one labelled document of so many is held back from the fit, to set the cut
HOLD_BACK = 5
#: share of the held-back top-grade documents that the cut keeps
KEEP_GOOD = 0.985


@dataclass
class Ordinal:
    """Weights by slot and ordered thresholds; grades are 0 .. len(theta)."""
    w: np.ndarray
    theta: np.ndarray
    cut: float = 0.5

    def keep_at(self) -> float:
        """Least probability of the top grade at which a document stays, set
        on labelled documents held back from the fit (``KEEP_GOOD``)."""
        return self.cut

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(rows, K - 1): P(grade >= k), k = 1 .. K - 1."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.theta[None, :], -60, 60)))


def fit(rows: np.ndarray, slots: np.ndarray, y: np.ndarray, epochs: int = EPOCHS,
        seed: int = 3) -> Ordinal:
    """Proximal AdaGrad on the cumulative-link likelihood; slots seen in fewer
    than ``MIN_DF`` documents stay at 0."""
    n, k = len(y), int(y.max())
    df = np.bincount(slots, minlength=1 << BITS)
    use = df[slots] >= MIN_DF
    rows, slots = rows[use], slots[use]
    bounds = np.searchsorted(rows, np.arange(n + 1))
    w, acc = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    first, gaps = -1.0, np.zeros(max(k - 1, 0))
    tacc = np.full(k, 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(n)
        for b in range(0, n, BATCH):
            pick = order[b:b + BATCH]
            sl = [slots[bounds[i]:bounds[i + 1]] for i in pick]
            s = np.array([w[a].sum() for a in sl])
            theta = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
            tail = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None, :], -30, 30)))
            full = np.concatenate([np.ones((len(pick), 1)), tail, np.zeros((len(pick), 1))], axis=1)
            yy, at = y[pick], np.arange(len(pick))
            upper, lower = full[at, yy], full[at, yy + 1]
            p = np.maximum(upper - lower, 1e-9)
            gs = -(1 - upper - lower)
            gt = np.zeros(k)
            np.add.at(gt, yy[yy >= 1] - 1, (upper * (1 - upper) / p)[yy >= 1])
            np.add.at(gt, yy[yy < k], -(lower * (1 - lower) / p)[yy < k])
            flat = np.concatenate(sl)
            g = np.repeat(gs, [len(a) for a in sl])
            touched, where = np.unique(flat, return_inverse=True)
            grad = np.bincount(where, g) / len(pick)
            acc[touched] += grad * grad
            step = RATE / np.sqrt(acc[touched])
            moved = w[touched] - step * grad
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
            # thresholds: the first, then logs of the gaps, so they stay ordered
            gt /= len(pick)
            tail_sum = np.cumsum(gt[::-1])[::-1]
            par = np.concatenate([[tail_sum[0]], tail_sum[1:] * np.exp(gaps)])
            tacc += par * par
            move = RATE * par / np.sqrt(tacc)
            first -= move[0]
            gaps -= move[1:]
    return Ordinal(w.astype(np.float32), first + np.concatenate([[0], np.cumsum(np.exp(gaps))]))


def train(docs: DataFrame, labels: DataFrame, grade: Column, text: str = "text",
          key: str = "doc_id", per_grade: int = PER_GRADE) -> Ordinal | None:
    """Fit on a bounded sample of ``labels`` (columns ``key`` and those of
    ``grade``, an integer from 0 up) joined with the documents' texts."""
    h = F.xxhash64(F.col(key).cast("string"), F.lit(13))
    rated = (labels.select(F.col(key).alias("id"), grade.cast("int").alias("y"), h.alias("h"))
                   .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & (F.col("y") >= 0)))
    picked = bounded_sample(rated, "y", "h", per_grade).select("id", "y")
    # at most per_grade rows of each grade: bounded, so the texts do not move
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    hashed = F.arrow_udf(_slots, "array<int>")
    sample = (texts.join(F.broadcast(picked), "id")
                   .select("id", "y", hashed(F.coalesce("text", F.lit(""))).alias("slots")).collect())
    sample.sort(key=lambda r: (r["id"], r["y"], r["slots"]))
    y = np.array([r["y"] for r in sample], np.intp)
    if len(np.unique(y)) < 2:
        return None
    # the sample is sorted, so every HOLD_BACK-th row is the same part in every run
    held = np.arange(len(sample)) % HOLD_BACK == HOLD_BACK - 1
    if len(np.unique(y[~held])) < len(np.unique(y)) or not (y[held] == y.max()).any():
        held[:] = False
    model = fit(*_flat([r for r, h in zip(sample, held) if not h]), y[~held])
    good = [r for r, h, g in zip(sample, held, y) if h and g == y.max()]
    if good:
        rows, slots = _flat(good)
        top = np.sort(model.tails(np.bincount(rows, model.w[slots], minlength=len(good)))[:, -1])
        model.cut = float(top[int((1 - KEEP_GOOD) * len(top))])
    return model


def _flat(sample: list) -> tuple[np.ndarray, np.ndarray]:
    """Row number and slot of every slot of the sampled rows."""
    rows = np.repeat(np.arange(len(sample)), [len(r["slots"]) for r in sample])
    return rows, np.concatenate([np.array(r["slots"], np.int32) for r in sample])


def _slots(texts: pa.Array) -> pa.Array:
    rows, slots = features(texts)
    offsets = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(slots))


def score(df: DataFrame, model: Ordinal | None, text: str = "text", keep_grade: int | None = None,
          keep_at: float = 0.5) -> DataFrame:
    """``df`` plus ``expected_grade``, ``tails`` (array of P(grade >= k)) and
    ``kept``: P(grade >= keep_grade) >= keep_at (top grade by default)."""
    names = ("expected_grade", "tails", "kept")
    base = df.drop(*names)
    if model is None:
        return base.select("*", F.lit(None).cast("double").alias(names[0]),
                           F.lit(None).cast("array<double>").alias(names[1]), F.lit(True).alias(names[2]))
    keep_grade = len(model.theta) if keep_grade is None else keep_grade
    used = np.flatnonzero(model.w)
    sent = df.sparkSession.sparkContext.broadcast((used, model.w[used], model.theta))

    def run(texts: pa.Array) -> pa.Array:
        used, values, theta = sent.value
        w = np.zeros(1 << BITS, np.float32)
        w[used] = values
        s = np.zeros(len(texts))
        for at, part in slices(texts):
            rows, slots = _features(part)
            s[at:at + len(part)] = np.bincount(rows, w[slots], minlength=len(part))
        tails = Ordinal(w, theta).tails(s)
        offsets = np.arange(0, tails.size + 1, tails.shape[1], dtype=np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(tails.sum(axis=1)),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(tails.ravel()))], names=["e", "t"])

    out, = fresh(base, ["scored"])
    udf = F.arrow_udf(run, "e double, t array<double>")
    marked = base.withColumn(out, udf(F.coalesce(F.col(text), F.lit(""))))
    return marked.select(*base.columns, F.col(f"{out}.e").alias(names[0]), F.col(f"{out}.t").alias(names[1]),
                         (F.element_at(F.col(f"{out}.t"), keep_grade) >= keep_at).alias(names[2]))
