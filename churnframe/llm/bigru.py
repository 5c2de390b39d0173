"""Operator 9, language identification by a bidirectional gated recurrent
network over bytes.

The units are gated recurrent units with piecewise-linear gates and a softsign
candidate, which cost a fraction of exponentials.  The network reads windows of ``WINDOW`` bytes in both directions, labels every
byte position with language probabilities, and a document's probabilities are
the mean over all its positions (whole text, every byte).  It is trained in
numpy by backpropagation through time on a bounded sample: at most
``PER_LANG`` documents of each language, chosen by hash, ``WINDOWS_PER_DOC``
windows each.  Inference runs inside Arrow tasks; only the weights (a few
thousand numbers) are broadcast.

Defined results: null text or text without a letter gives ``und`` with score
0; an empty training sample gives ``und`` for every row; equal probabilities
go to the language that sorts first; repeated rows get equal results; extra
columns are passed through and take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import bounded_sample, fresh
from churnframe.llm.wordhash import text_buffers

WINDOW = 64
HIDDEN = 8
PER_LANG = 600
WINDOWS_PER_DOC = 4
STEPS = 300
BATCH = 192
RATE = 0.02
BLOCK = 2048

_F = np.float32


def _gate(x: np.ndarray) -> np.ndarray:
    """Hard sigmoid: 0 below -2, 1 above 2, linear between."""
    return np.clip(x * _F(0.25) + _F(0.5), 0, 1)


class BiGRU:
    """Weights: ``x`` (2, 3H, 256) input tables with bias, ``u`` (2, 3H, H),
    ``c`` (2, H, 1) bias of the candidate's recurrent part, ``o`` (C, 2H + 1)."""

    def __init__(self, n_classes: int, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        h = hidden
        self.h = h
        self.w = {"x": rng.normal(0, 0.3, (2, 3 * h, 256)).astype(_F),
                  "u": rng.normal(0, 1 / np.sqrt(h), (2, 3 * h, h)).astype(_F),
                  "c": np.zeros((2, h, 1), _F),
                  "o": rng.normal(0, 0.3, (n_classes, 2 * h + 1)).astype(_F)}

    def _run(self, data: np.ndarray):
        """data (L, B) bytes -> states (L, 2H, B) aligned by position, and the
        steps' intermediate values for training."""
        L, B = data.shape
        h, w = self.h, self.w
        states = np.empty((L, 2 * h, B), _F)
        tape = []
        s = np.zeros((2, h, B), _F)
        for t in range(L):
            x = np.stack([w["x"][0][:, data[t]], w["x"][1][:, data[L - 1 - t]]])
            g = np.matmul(w["u"], s)
            gates = _gate(x[:, :2 * h] + g[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            rec = g[:, 2 * h:] + w["c"]
            v = x[:, 2 * h:] + r * rec
            n = v / (1 + np.abs(v))
            tape.append((s, z, r, rec, n))
            s = n + z * (s - n)
            states[t, :h] = s[0]
            states[L - 1 - t, h:] = s[1]
        return states, tape

    def _states(self, data: np.ndarray) -> np.ndarray:
        """The states alone, in place; the gates' slope and offset are folded
        into the weights once."""
        L, B = data.shape
        h = self.h
        slope = np.ones((1, 3 * h, 1), _F)
        slope[:, :2 * h] = 0.25
        tables, u, c = self.w["x"] * slope, self.w["u"] * slope, self.w["c"]
        tables[:, :2 * h] += _F(0.5)
        states = np.empty((L, 2 * h, B), _F)
        s = np.zeros((2, h, B), _F)
        x, g = np.empty((2, 3 * h, B), _F), np.empty((2, 3 * h, B), _F)
        gates, n = g[:, :2 * h], g[:, 2 * h:]
        size = np.empty((2, h, B), _F)
        for t in range(L):
            np.take(tables[0], data[t], axis=1, out=x[0], mode="clip")
            np.take(tables[1], data[L - 1 - t], axis=1, out=x[1], mode="clip")
            np.matmul(u, s, out=g)
            gates += x[:, :2 * h]
            np.clip(gates, 0, 1, out=gates)
            n += c
            n *= gates[:, h:]
            n += x[:, 2 * h:]
            np.abs(n, out=size)
            size += _F(1)
            n /= size
            s -= n
            s *= gates[:, :h]
            s += n
            states[t, :h] = s[0]
            states[L - 1 - t, h:] = s[1]
        return states

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """(L, B) bytes -> (L, C, B) probabilities of every position."""
        o = self.w["o"]
        p = np.matmul(o[:, :-1], self._states(data))
        p += o[:, -1:]
        if np.abs(o).sum(axis=1).max() > 80:  # states lie in (-1, 1)
            p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, data: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """Mean cross-entropy over unmasked positions and its gradients."""
        L, B = data.shape
        h, w = self.h, self.w
        states, tape = self._run(data)
        p = np.matmul(w["o"][:, :-1], states) + w["o"][:, -1:]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        total = max(mask.sum(), 1)
        picked = p[:, y, np.arange(B)]
        loss = -(np.log(np.maximum(picked, 1e-9)) * mask).sum() / total
        d = p
        d[:, y, np.arange(B)] -= 1
        d *= (mask / total)[:, None, :].astype(_F)
        go = np.zeros_like(w["o"])
        go[:, :-1] = np.matmul(d, states.transpose(0, 2, 1)).sum(0)
        go[:, -1] = d.sum((0, 2))
        ds = np.matmul(w["o"][:, :-1].T, d)
        gx, gu, gc = np.zeros_like(w["x"]), np.zeros_like(w["u"]), np.zeros_like(w["c"])
        back = np.zeros((2, h, B), _F)
        for t in range(L - 1, -1, -1):
            s, z, r, rec, n = tape[t]
            back = back + np.stack([ds[t, :h], ds[L - 1 - t, h:]])
            dn = back * (1 - z) * (1 - np.abs(n)) ** 2
            dz = back * (s - n) * ((z > 0) & (z < 1)) * _F(0.25)
            dr = dn * rec * ((r > 0) & (r < 1)) * _F(0.25)
            drec = dn * r
            dx = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, drec], axis=1)
            for k, col in ((0, data[t]), (1, data[L - 1 - t])):
                hot = np.zeros((B, 256), _F)
                hot[np.arange(B), col] = 1
                gx[k] += dx[k] @ hot
            gu += np.matmul(dg, s.transpose(0, 2, 1))
            gc += drec.sum(2, keepdims=True)
            back = back * z + np.matmul(w["u"].transpose(0, 2, 1), dg)
        return loss, {"x": gx, "u": gu, "c": gc, "o": go}

    def fit(self, data: np.ndarray, mask: np.ndarray, y: np.ndarray, steps: int = STEPS,
            batch: int = BATCH, rate: float = RATE, seed: int = 5) -> float:
        """Adam with norm clipping; classes are drawn in equal shares."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(a) for k, a in self.w.items()}
        groups = [np.flatnonzero(y == c) for c in np.unique(y)]
        loss = float("nan")
        for i in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
            loss, grad = self.gradients(data[:, pick], mask[:, pick], y[pick])
            norm = np.sqrt(sum(float((a * a).sum()) for a in grad.values()))
            scale = min(1.0, 1.0 / (norm + 1e-6))
            step = rate * min(1.0, 2 * (1 - (i - 1) / steps))
            for k, a in grad.items():
                a *= _F(scale)
                m[k] += _F(0.1) * (a - m[k])
                v[k] += _F(0.01) * (a * a - v[k])
                self.w[k] -= _F(step) * (m[k] / _F(1 - 0.9 ** i)) / (
                    np.sqrt(v[k] / _F(1 - 0.99 ** i)) + _F(1e-6))
        return loss


def cut_windows(raw: np.ndarray, offsets: np.ndarray, width: int = WINDOW):
    """Window starts, ends and rows: consecutive windows that cover all bytes."""
    lengths = np.diff(offsets)
    count = -(-lengths // width)
    rows = np.repeat(np.arange(len(lengths)), count)
    first = np.cumsum(count) - count
    starts = offsets[:-1][rows] + (np.arange(len(rows)) - first[rows]) * width
    return starts, np.minimum(starts + width, offsets[1:][rows]), rows


def gather(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WINDOW):
    """(width, n) bytes, 0 beyond a window's end, and the mask of real bytes."""
    at = starts[None, :] + np.arange(width)[:, None]
    mask = at < ends[None, :]
    data = raw[np.minimum(at, max(len(raw) - 1, 0))] * mask
    return data.astype(np.intp), mask


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          per_lang: int = PER_LANG, steps: int = STEPS) -> tuple[BiGRU, list[str]] | None:
    """Fit on at most ``per_lang`` documents of each language of ``df``."""
    h = F.xxhash64(F.col(key).cast("string"), F.lit(7))
    span = F.greatest(F.length(F.col(text)) - WINDOW, F.lit(0)) + 1
    pieces = F.array(*[
        F.substring(F.col(text), (F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(j)), span) + 1).cast("int"),
                    F.lit(WINDOW)) for j in range(WINDOWS_PER_DOC)])
    learn = (df.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
               .select(F.col(lang).alias("lang"), h.alias("h"), pieces.alias("pieces")))
    sample = bounded_sample(learn, "lang", "h", per_lang).collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r["lang"], r["h"], r["pieces"]))
    langs = sorted({r["lang"] for r in sample})
    pieces = [(langs.index(r["lang"]), p.encode()[:WINDOW]) for r in sample for p in r["pieces"] if p]
    raw = np.frombuffer(b"".join(p for _, p in pieces), np.uint8)
    ends = np.cumsum([len(p) for _, p in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    data, mask = gather(raw, starts, ends)
    model = BiGRU(len(langs))
    model.fit(data, mask, np.array([c for c, _ in pieces]), steps=steps)
    return model, langs


def pooled(model: BiGRU, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, C) mean probabilities over all positions of each row."""
    starts, ends, rows = cut_windows(raw, offsets)
    n_classes = model.w["o"].shape[0]
    total = np.zeros((len(offsets) - 1, n_classes))
    for k in range(0, len(starts), BLOCK):
        data, mask = gather(raw, starts[k:k + BLOCK], ends[k:k + BLOCK])
        p = model.probabilities(data)
        p *= mask[:, None, :]
        sums = p.sum(axis=0, dtype=np.float64)
        for c in range(n_classes):
            total[:, c] += np.bincount(rows[k:k + BLOCK], sums[c], minlength=len(total))
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def predict(df: DataFrame, fitted: tuple[BiGRU, list[str]] | None, text: str = "text") -> DataFrame:
    """``df`` plus ``lang_pred`` and ``score`` (earlier columns of those names
    are replaced)."""
    if fitted is None:
        return df.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))
    model, langs = fitted
    sent = df.sparkSession.sparkContext.broadcast((model, langs))

    def label(texts: pa.Array) -> pa.Array:
        model, langs = sent.value
        raw, offsets = text_buffers(texts)
        p = pooled(model, raw, offsets)
        best = p.argmax(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array([langs[b] for b in best], pa.string()),
             pa.array(np.clip(p[np.arange(len(p)), best], 0, 1), pa.float64())],
            names=["lang", "score"])

    out, = fresh(df, ["label"])
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    udf = F.arrow_udf(label, "lang string, score double")
    marked = df.withColumn(out, udf(F.coalesce(F.col(text), F.lit(""))))
    return (marked.withColumn("lang_pred", F.when(has_letter, F.col(f"{out}.lang")).otherwise("und"))
                  .withColumn("score", F.when(has_letter, F.col(f"{out}.score")).otherwise(0.0))
                  .drop(out))
