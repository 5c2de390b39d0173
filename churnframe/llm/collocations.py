"""Operator 11, phrase collocations by Toivonen's sampling method.

1. A sample of the texts (by a hash of the row, ``SAMPLE_SHARE`` of them)
   proposes the words and phrases that are frequent there at a lowered
   threshold.
2. A full pass counts, exactly, every word, and of the longer phrases those
   whose two parts shortened by a word are both proposed: the proposed phrases
   and their negative border, the phrases just outside.
3. A phrase that proves frequent though it was not proposed is a failure of the
   border: phrases built on it may have gone uncounted.  Further passes count
   the phrases that become possible and were not counted before, until no new
   frequent phrase turns up that another could be built on.  Each pass settles
   one more length for good, so there are at most ``max_words`` of them.

Counting a slice of texts is numpy work (words and phrases become integers by
dictionary encoding); a task hands on each distinct phrase of a slice once,
with its count, and a shuffle adds them up.  Proposals reach the tasks as a
bit filter of at most ``FILTER_BITS``; phrases it holds by mistake are counted
too, which costs time and changes nothing, as all verdicts rest on exact
counts.  Whether an earlier pass counted a phrase is asked of the same filters.

Scores, containment and ranks are joins and aggregations on phrases; numbers
are exact (decimal products of up to 38 digits).

Defined results: a null text counts as empty, a null language as ``und``;
texts of any length are read whole; repeated rows count again; an empty table
gives an empty result; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnframe.llm.arrow_text import holds, mix, positions, slices
from churnframe.llm.common import materialize_as

SLICE_BYTES = 3 << 20
SAMPLE_SHARE = 0.125
FILTER_BITS = 1 << 28
#: parts that the phrases of a language are ranked in before the last ranking
RANK_PARTS = 64
PHRASES = "lang string, size int, phrase string, n long"

# what a byte is: part of a word, a blank between words, or the end of a piece
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _hash_words(words: pa.Array) -> np.ndarray:
    import pandas as pd
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.zeros(0, np.uint64)


def _seed(lang: str) -> np.ndarray:
    return _hash_words(pa.array([lang.encode()], pa.large_binary()))


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of ``texts``, the code of each word occurrence, and
    whether it goes on the piece of the word before it."""
    buf = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _KIND[buf]
    inside = kind == 0
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    data = _LOWER[buf[inside]]
    at = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    raw = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data)])
    coded = raw.dictionary_encode()
    ends = np.cumsum(kind == 2)
    piece = ends[start] if len(start) else np.zeros(0, np.int64)
    follows = np.concatenate(([False], piece[1:] == piece[:-1])) if len(start) else np.zeros(0, bool)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), follows


def _held(by_size: dict, size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which phrases of ``size`` words a pass counts: both parts proposed."""
    packed, bits = by_size[size - 1]
    out = holds(packed, bits, left)
    out[out] = holds(packed, bits, right[out])
    return out


def count_slice(texts: list[bytes], lang: str, max_words: int, filters: list | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(size, phrases, counts) of texts in one language; size 0 is the number
    of words.  ``filters`` is None in the sample (all phrases below
    ``max_words`` words are counted), else one entry per pass so far, each
    ``{size of the parts: (bits, number)}``."""
    words, code, follows = words_of(texts)
    n = len(code)
    if not n:
        return
    w_hash, blank = _hash_words(words), pa.scalar(b" ", pa.large_binary())
    if filters is None or len(filters) == 1:
        yield 0, pa.array([b""], pa.large_binary()), np.array([n])
        yield 1, words, np.bincount(code, minlength=len(words))
    at, h = np.arange(n), mix(_seed(lang), w_hash)[code]  # places of the parts, hash of the part at each place
    for size in range(2, max_words + (0 if filters is None else 1)):
        at = at[at + size - 1 < n]
        at = at[follows[at + size - 1]]
        pos = at
        if filters is not None:
            on = _held(filters[-1], size, h[pos], h[pos + 1])
            pos = pos[on]
            for by_size in filters[:-1]:
                pos = pos[~_held(by_size, size, h[pos], h[pos + 1])]
        if len(pos):
            key = code[pos]
            for k in range(1, size):
                found, first, key, counts = np.unique(key * len(words) + code[pos + k], return_index=True,
                                                      return_inverse=True, return_counts=True)
            parts = [words.take(pa.array(code[pos[first] + k])) for k in range(size)]
            yield size, pc.binary_join_element_wise(*parts, blank), counts
        longer = np.zeros(n, np.uint64)
        longer[at] = mix(h[at], w_hash[code[at + size - 1]])
        h = longer


def _count(texts: DataFrame, max_words: int, filters, slice_bytes: int) -> DataFrame:
    """Summed counts of ``texts`` (text, lang); ``filters`` as in
    ``count_slice``, broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = filters.value if filters else None
        for t in slices(batches, "text", slice_bytes):
            langs = t.column("lang").combine_chunks()
            for lang in pc.unique(langs).to_pylist():
                mine = t.column("text").filter(pc.equal(langs, lang)).cast(pa.large_binary()).to_pylist()
                for size, phrase, n in count_slice(mine, lang, max_words, known):
                    for s in range(0, len(phrase), 100_000):
                        part = phrase.slice(s, 100_000).cast(pa.binary()).cast(pa.string())
                        k = len(part)
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(pa.scalar(lang), k), pa.repeat(pa.scalar(size, pa.int32()), k), part,
                             pa.array(n[s:s + k].astype(np.int64))], ["lang", "size", "phrase", "n"])
    # a slice has each phrase once, so rows go to the shuffle as they are: summing
    # before it would sort mostly distinct phrases for nothing
    rows = texts.mapInArrow(run, PHRASES).repartition("lang", "size", "phrase")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _filter_of(phrases: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bit filter of ``phrases``, built by Spark in parts of 32768 bits; its
    size follows their count, up to ``FILTER_BITS``."""
    bits = 1 << 15
    while bits < FILTER_BITS and bits < 12 * count:
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            langs = b.column("lang").to_pylist()
            seeds = {x: _seed(x)[0] for x in set(langs)}
            h = np.array([seeds[x] for x in langs], np.uint64)
            split = pc.split_pattern(b.column("phrase"), " ")
            size = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = _hash_words(pc.list_flatten(split).cast(pa.large_binary()))
            first = np.concatenate(([0], np.cumsum(size)))[:-1]
            for k in range(int(size.max())):
                on = size > k
                h[on] = mix(h[on], flat[first[on] + k])
            for p in positions(h, bits):
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64))], ["p"])
    parts = (phrases.select("lang", "phrase").mapInArrow(run, "p long")
             .groupBy(F.expr("p div 32768").alias("b"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bits")).collect())
    packed = np.zeros(bits // 8, np.uint8)
    for r in parts:
        packed[r["b"] * 4096:(r["b"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return packed, bits


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10, max_words: int = 3,
                     share: float = SAMPLE_SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Written table ``lang``, ``size``, ``phrase``, ``n``: every phrase of up
    to ``max_words`` words with its exact count of at least ``min_count``;
    size 0 holds the number of words of each language."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    if max_words < 2:
        raise ValueError("a phrase has at least two words")
    pick = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]), F.lit(1 << 20)) < int(share * (1 << 20))
    lowered = max(2, int(0.8 * share * min_count))
    sample = df.filter(pick).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    proposed = materialize_as(_count(sample, max_words, None, slice_bytes)
                              .filter((F.col("size") > 0) & (F.col("n") >= lowered)), "phrases-proposed")
    filters, source, tables = [], proposed, []
    while True:
        sizes = {r["size"]: r["count"] for r in source.groupBy("size").count().collect()}
        filters.append({s: _filter_of(source.filter(F.col("size") == s), sizes.get(s, 0)) for s in range(1, max_words)})
        found = materialize_as(_count(texts, max_words, spark.sparkContext.broadcast(filters), slice_bytes)
                               .filter((F.col("size") == 0) | (F.col("n") >= min_count)), "phrases-counted")
        tables.append(found)
        # frequent, able to be part of a longer phrase, and not proposed: the border failed
        failed = found.filter(F.col("size").between(1, max_words - 1)).join(proposed, ["lang", "size", "phrase"], "left_anti")
        if failed.limit(1).count() == 0:
            break
        source = tables[0]
        for t in tables[1:]:
            source = source.unionByName(t)
        proposed = source
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = 10, max_words: int = 3,
                 top: int = 2000, covered_percent: int = 50, share: float = SAMPLE_SHARE,
                 slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``.  The score is that of a phrase's
    weakest cut; phrases that lie in a longer one with at least
    ``covered_percent`` of their count are left out."""
    known = frequent_phrases(df, text, lang, min_count, max_words, share, slice_bytes)
    words = known.filter("size = 0").select("lang", F.col("n").alias("n_words"))
    counts = known.filter("size > 0").select("lang", "phrase", "n")
    cand = known.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    piece = lambda s, k: F.array_join(F.slice("w", s, k), " ")
    cut = cand.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"),
                     piece(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cut = (cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
              .join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]))
    scored = (cut.groupBy("lang", "phrase", "a")
                 .agg(F.min(F.struct(_floor_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("c")))
    inner = cand.filter("size > 2").select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("s"))
    inner = inner.groupBy("lang", piece(F.col("s"), F.col("k")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
                  .filter(F.coalesce(F.col("longer") * 100 < F.col("a") * covered_percent, F.lit(True))))
    # the best of each of RANK_PARTS parts first, so that no task ranks all
    # phrases of a language: the last one gets top x RANK_PARTS rows at most
    best = [F.desc("c.score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*best)
    first = kept.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*best)
    ranked = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                             F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("n_words").alias("n"),
                                             F.col("c.score").alias("score"))
