"""Operator 2, byte-level BPE with forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be merged over, so the text may be cut there for certain.  Pre-tokens are cut
at all such pairs; the fragments are encoded one by one (and remembered, since
few fragments make up most text) and their ids concatenated.  Results equal
the tokenizer's own encoding of the whole text without added tokens.

The vocabulary file is a parameter.  It is read on the driver and broadcast
(its size is that of the vocabulary, not of the data).

Defined results: null text encodes as the empty text (no ids, empty decoded
text); texts of any length are encoded whole, long fragments with a heap in
``n log n``; repeated rows give repeated results; an empty table gives an
empty result; extra columns are passed through.
"""

from __future__ import annotations

import heapq
import json
from array import array

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.llm.common import fresh

#: pre-token pattern of the vocabulary (fixed value, must equal the tokenizer's)
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
            r"|\s+(?!\S)|\s+")
#: entries remembered per worker; the memory is emptied when full
MEMORY_ENTRIES = 300_000
LONG_FRAGMENT = 48


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one vocabulary (``tokenizer.json`` text)."""

    def __init__(self, spec: str, memory: int = MEMORY_ENTRIES):
        import regex
        j = json.loads(spec)
        model, alphabet = j["model"], byte_alphabet()
        special = {t["content"]: t["id"] for t in j.get("added_tokens") or []}
        ids = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()
               if t not in special}
        self.token_bytes = {i: b for b, i in ids.items()}
        self.token_bytes |= {i: t.encode() for t, i in special.items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = (bytes(alphabet[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m))
            self.merges[ids[a], ids[b]] = (rank, ids[a + b])
        self.inside = {p for t in ids for p in zip(t, t[1:])}
        self.special = special
        self.split = (regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
                      if special else None)
        self.find = regex.compile(PRETOKEN).findall
        self.limit = memory
        self.pretokens: dict[str, tuple] = {}
        self.fragments: dict[bytes, tuple] = {}

    def cuts(self, b: bytes) -> list[bytes]:
        """Fragments of ``b`` between pairs that lie inside no token."""
        inside, out, s = self.inside, [], 0
        for i in range(1, len(b)):
            if (b[i - 1], b[i]) not in inside:
                out.append(b[s:i])
                s = i
        out.append(b[s:])
        return out

    def merge(self, b: bytes) -> tuple:
        """Ids of one fragment: lowest rank first, leftmost on ties."""
        if len(b) > LONG_FRAGMENT:
            return self._merge_long(b)
        ids, merges = [self.byte_id[x] for x in b], self.merges
        while len(ids) > 1:
            best = None
            for k in range(len(ids) - 1):
                m = merges.get((ids[k], ids[k + 1]))
                if m is not None and (best is None or m < best):
                    best, at = m, k
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return tuple(ids)

    def _merge_long(self, b: bytes) -> tuple:
        ids, merges = [self.byte_id[x] for x in b], self.merges
        n = len(ids)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (m := merges.get((ids[i], ids[j]))) is not None:
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, c, new = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != c:
                continue
            ids[i], alive[j], nxt[i] = new, False, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return tuple(x for x, ok in zip(ids, alive) if ok)

    def _pretoken(self, w: str) -> tuple:
        out: list = []
        for f in self.cuts(w.encode()):
            got = self.fragments.get(f)
            if got is None:
                got = self.merge(f)
                if len(f) <= LONG_FRAGMENT:
                    if len(self.fragments) >= self.limit:
                        self.fragments.clear()
                    self.fragments[f] = got
            out.extend(got)
        got = tuple(out)
        if len(w) <= LONG_FRAGMENT:
            if len(self.pretokens) >= self.limit:
                self.pretokens.clear()
            self.pretokens[w] = got
        return got

    def encode(self, text: str) -> array:
        ids, known, make = array("I"), self.pretokens, self._pretoken
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                ids.append(self.special[part])
                continue
            flat: list = []
            for w in self.find(part):
                got = known.get(w)
                flat.extend(make(w) if got is None else got)
            ids.extend(flat)
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(spec) -> Codec:
    """One codec per worker process and broadcast vocabulary."""
    key = hash(spec.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec.value)
    return _CODECS[key]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def codec_udf(spark: SparkSession, vocabulary: str | None = None):
    """UDF text -> struct(n_tokens, ids, decoded): ``ids`` holds the ids as
    little-endian unsigned 32-bit integers, ``decoded`` the text they give."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(texts: pd.Series) -> pd.DataFrame:
        import sys
        codec = _codec(spec)
        rows = []
        for t in texts:
            ids = codec.encode(t or "")
            decoded = codec.decode(ids)
            if sys.byteorder != "little":
                ids.byteswap()
            rows.append((len(ids), ids.tobytes(), decoded))
        return pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    return F.pandas_udf(run, "n_tokens long, ids binary, decoded string")


def encode_decode(df: DataFrame, text: str = "text", vocabulary: str | None = None,
                  prefix: str = "bpe_") -> DataFrame:
    """``df`` plus ``<prefix>n_tokens``, ``<prefix>ids`` and ``<prefix>decoded``."""
    coded, = fresh(df, ["coded"])
    out = df.withColumn(coded, codec_udf(df.sparkSession, vocabulary)(F.coalesce(F.col(text), F.lit(""))))
    return out.select(*df.columns, *[F.col(f"{coded}.{c}").alias(prefix + c)
                                     for c in ("n_tokens", "ids", "decoded")])


def sha256(column: str) -> Column:
    return F.sha2(F.col(column), 256)
