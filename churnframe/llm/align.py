"""Operator 12, alignment of two tokenizers by galloping intersection.

Each text is encoded by two vocabularies, A and B.  The byte offsets where a
token ends are two sorted lists.  The shorter list drives: each of its ends is
sought in the longer one by steps that double, then by halving the last step.
Ends found in both cut the text into groups; the difference of the ranks of
neighbouring ends is the range of tokens of the longer list that overlap the
driver's token, which gives all links.

No token of A holds a character that is not white space before a blank, and no
token of B anything before a blank but blanks; so both encode the stretches
between such places alike in any text.  A slice of texts is cut there, and its
distinct stretches are encoded and aligned once, all searches of the slice in
step (numpy).

The work runs in four steps, each a Spark job over written tables:

1. slices: per slice of texts (``SLICE_BYTES``) the figures of each document,
   the distinct stretches' links and the distinct id pairs with their counts,
   written in row groups of about ``GROUP_BYTES``;
2. pair counts: summed over all slices by a shuffle, one row per id pair;
3. the best count of each B id (as many rows as B has ids);
4. figures that need the counts, per document.  The commonest pairs, at most
   ``BROADCAST_PAIRS``, are broadcast (16 bytes each, so bounded); links of
   the others are joined by a shuffle of (document, pair, links) rows.

Defined results: texts that are null or empty, or that A or B does not give
back byte for byte, have no tokens: zeros and the empty string, and their links
are not counted; texts of any length are encoded whole; repeated rows give
repeated results; an empty table gives an empty result; extra columns are
passed through, but for those that the results' names replace.
"""

from __future__ import annotations

import gc
import hashlib
import itertools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnframe.llm.arrow_text import lists, offsets, ranges, slices, sums
from churnframe.llm.common import materialize_as

SLICE_BYTES = 2 << 20
#: stretches whose ids a worker remembers; emptied when full
MEMORY_ENTRIES = 50_000
#: stretches encoded and aligned at a time
ENCODED = 10_000
#: a row group of the written slices.  A reader holds a whole row group of each
#: column, and a slice is megabytes; by default Parquet looks at the size of a
#: group after 100 rows only
GROUP_BYTES = 8 << 20
BROADCAST_PAIRS = 3_000_000
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


class Pair:
    """Both tokenizers, from the texts of their vocabulary files."""

    def __init__(self, spec_a: str, spec_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        from churnframe.llm.bpe import byte_alphabet
        self.a = Tokenizer.from_str(spec_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=spec_b)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            bytes_a[i] = bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
        bytes_b = []
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                bytes_b.append(bytes([int(p[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                bytes_b.append(b"")
            else:
                bytes_b.append(p.replace("▁", " ").encode())
                if "▁" in p.lstrip("▁"):
                    raise ValueError(f"piece {p!r} holds a blank after other characters")
        self.bytes_a, self.bytes_b = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        self.known: dict[str, tuple] = {}

    def encode(self, stretches: pa.Array, uses: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B the ids of all stretches, joined, and how many each has;
        a stretch begins with a blank, which B adds itself to all but the empty
        text.  ``ENCODED`` stretches at a time are Python objects.  Short ones
        used again are remembered."""
        known, blank = self.known, [self.b.piece_to_id("▁")]
        ids: tuple[list, list] = ([], [])
        counts: tuple[list, list] = ([], [])
        collecting = gc.isenabled()
        gc.disable()  # many small lists and no cycles
        try:
            for k in range(0, len(stretches), ENCODED):
                part = [s.decode() for s in stretches.slice(k, ENCODED).to_pylist()]
                got = [known.get(s) for s in part]
                new = [i for i, x in enumerate(got) if x is None]
                texts = [part[i] for i in new]
                encoded = self.a.encode_batch(texts, add_special_tokens=False)
                for i, a, b in zip(new, encoded, self.b.encode([s[1:] for s in texts], num_threads=1)):
                    got[i] = (a.ids, b or blank)
                del encoded
                if len(known) > MEMORY_ENTRIES:
                    known.clear()
                known.update((part[i], got[i]) for i in new if uses[k + i] > 2 and len(part[i]) <= 32)
                for side in (0, 1):
                    mine = [x[side] for x in got]
                    n = np.fromiter(map(len, mine), np.int64, len(mine))
                    counts[side].append(n)
                    ids[side].append(np.fromiter(itertools.chain.from_iterable(mine), np.int32, int(n.sum())))
        finally:
            if collecting:
                gc.enable()
        return [(np.concatenate([np.zeros(0, np.int32), *i]), np.concatenate([np.zeros(0, np.int64), *n]))
                for i, n in zip(ids, counts)]


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def stretch_starts(buf: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where ``buf`` may be cut: at each text, and before each blank whose
    previous character is no white space (of any script)."""
    at = np.flatnonzero(buf == 32)
    at = at[at > 0]
    p1 = buf[at - 1]
    p2, p3 = buf[np.maximum(at - 2, 0)], buf[np.maximum(at - 3, 0)]
    wide = ((p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))) | ((p3 == 0xE2) & ((p2 == 0x80) | (p2 == 0x81))) \
        | ((p3 == 0xE3) & (p2 == 0x80)) | ((p3 == 0xE1) & (p2 == 0x9A))
    cut = np.zeros(len(buf), bool)
    cut[at[~_BLANK[p1] & ~wide]] = True
    cut[text_starts] = True
    return np.flatnonzero(cut)


def gallop(wanted: np.ndarray, into: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each ``wanted[i]`` the first index in ``[lo[i], hi[i])`` of the
    sorted ``into`` whose value is not below it: steps double from ``lo`` until
    one passes it, then the last step is halved.  All searches run in step; a
    search that has ended drops out."""
    low, top = lo.copy(), np.minimum(lo, hi - 1)
    active = np.flatnonzero(into[top] < wanted)
    step = 1
    while len(active):
        low[active] = top[active] + 1
        top[active] = np.minimum(lo[active] + step, hi[active] - 1)
        active = active[into[top[active]] < wanted[active]]
        step *= 2
    while True:
        active = np.flatnonzero(low < top)
        if not len(active):
            return low
        mid = (low[active] + top[active]) >> 1
        below = into[mid] < wanted[active]
        low[active[below]] = mid[below] + 1
        top[active[~below]] = mid[~below]


def align(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray,
          n_a: np.ndarray, n_b: np.ndarray) -> dict:
    """Groups and links of many stretches at once.  ``ends_*`` are offsets in
    the joined stretches (so sorted throughout), ``n_*`` tokens per stretch.
    Result: ``group_a``/``group_b`` tokens per group, ``groups`` groups per
    stretch, ``link_a``/``link_b`` the ids of each link, ``links`` links per
    stretch, in the order of the stretches."""
    at_a, at_b = offsets(n_a), offsets(n_b)
    unit = np.arange(len(n_a))
    short_a = n_a <= n_b
    parts = []
    for a_drives in (True, False):
        u = unit[short_a == a_drives]
        nd, ni, d_at, i_at = (n_a, n_b, at_a, at_b) if a_drives else (n_b, n_a, at_b, at_a)
        d_ends, i_ends = (ends_a, ends_b) if a_drives else (ends_b, ends_a)
        d = ranges(d_at[u], nd[u])
        lo, hi = np.repeat(i_at[u], nd[u]), np.repeat(i_at[u] + ni[u], nd[u])
        rank = gallop(d_ends[d], i_ends, lo, hi)
        both = i_ends[rank] == d_ends[d]
        first = np.empty_like(rank)
        if len(rank):
            first[1:] = rank[:-1] + both[:-1]
            first[0] = lo[0]
        head = offsets(nd[u])[:-1]
        first[head[nd[u] > 0]] = i_at[u][nd[u] > 0]
        width = rank - first + 1
        owner = np.repeat(u, nd[u])
        di, ii = np.repeat(d, width), ranges(first, width)
        # a group ends where both do; its tokens are counted between such ends
        g = np.flatnonzero(both)
        gd = np.diff(np.concatenate(([-1], g)))
        g_rank, g_owner = rank[g], owner[g]
        prev = np.concatenate(([0], g_rank[:-1] + 1))
        new = np.concatenate(([True], g_owner[1:] != g_owner[:-1])) if len(g) else np.zeros(0, bool)
        prev = np.where(new, i_at[g_owner], prev) if len(g) else prev[:0]
        gi = g_rank - prev + 1
        parts.append((g_owner, *((gd, gi) if a_drives else (gi, gd)), np.repeat(owner, width),
                      *((ids_a[di], ids_b[ii]) if a_drives else (ids_a[ii], ids_b[di]))))
    owner, ga, gb, l_owner, la, lb = (np.concatenate(x) for x in zip(*parts))
    by_group, by_link = np.argsort(owner, kind="stable"), np.argsort(l_owner, kind="stable")
    n = len(n_a)
    return {"group_a": ga[by_group], "group_b": gb[by_group], "groups": np.bincount(owner, minlength=n),
            "link_a": la[by_link], "link_b": lb[by_link], "links": np.bincount(l_owner, minlength=n)}


def align_parts(ids: list, ends: list, n: list) -> dict:
    """``align`` of A's and B's tokens, ``ENCODED`` stretches at a time: its
    working arrays take some 150 bytes a token."""
    at, parts = [offsets(x) for x in n], []
    for k in range(0, max(len(n[0]), 1), ENCODED):
        stop = min(k + ENCODED, len(n[0]))
        tokens = [slice(x[k], x[stop]) for x in at]
        parts.append(align(*(x[t] for x, t in zip(ids, tokens)), *(x[t] for x, t in zip(ends, tokens)),
                           *(x[k:stop] for x in n)))
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def group_strings(got: dict, ids_a: np.ndarray, ids_b: np.ndarray) -> pa.Array:
    """Per stretch ``a1,a2|b1;a3|b2,b3``."""
    comma, bar, semi = (pa.scalar(x, pa.large_string()) for x in ",|;")
    a, b = (pc.binary_join(lists(offsets(got[k]), pc.cast(pa.array(ids), pa.large_string())), comma)
            for k, ids in (("group_a", ids_a), ("group_b", ids_b)))
    return pc.binary_join(lists(offsets(got["groups"]), pc.binary_join_element_wise(a, b, bar)), semi)


def _same(joined: pa.Array, lengths: np.ndarray, buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which stretches the joined token bytes (``lengths`` per stretch) equal."""
    ok = lengths == sizes
    mine = np.frombuffer(joined.buffers()[2], np.uint8) if len(joined) else np.zeros(0, np.uint8)
    pos, ref = ranges(offsets(lengths)[:-1][ok], lengths[ok]), ranges(starts[ok], sizes[ok])
    wrong = sums((mine[pos] != buf[ref]).astype(np.int64), offsets(lengths[ok]))
    ok[np.flatnonzero(ok)[wrong > 0]] = False
    return ok


def encode_slice(texts: list[bytes], pair: Pair) -> dict:
    """Figures, links and pair counts of a slice of texts."""
    n_docs = len(texts)
    body = [b" " + t if t else b"" for t in texts]
    size = np.array([len(b) for b in body], np.int64)
    buf = np.frombuffer(b"".join(body), np.uint8)
    text_starts = offsets(size)
    starts = stretch_starts(buf, text_starts[:-1][size > 0])
    at = np.concatenate((starts, [len(buf)])).astype(np.int64)
    stretches = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(buf)])
    coded = stretches.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int32)
    distinct = coded.dictionary
    n = len(distinct)
    (ids_a, n_a), (ids_b, n_b) = pair.encode(distinct, np.bincount(codes, minlength=n))
    d_at = np.frombuffer(distinct.buffers()[1], np.int64)[:n + 1] if n else np.zeros(1, np.int64)
    d_buf = np.frombuffer(distinct.buffers()[2], np.uint8) if n else np.zeros(0, np.uint8)
    ok, ends = np.ones(n, bool), []
    for ids, k, table in ((ids_a, n_a, pair.bytes_a), (ids_b, n_b, pair.bytes_b)):
        token_bytes = table.take(pa.array(ids))
        width = pc.binary_length(token_bytes).to_numpy()
        ends.append(np.cumsum(width))
        ok &= _same(token_bytes, sums(width, offsets(k)), d_buf, d_at[:-1], np.diff(d_at))
    # stretches that are not given back are left out before the ends are compared
    unit = np.flatnonzero(ok)
    tokens = []
    for ids, e, k in ((ids_a, ends[0], n_a), (ids_b, ends[1], n_b)):
        pick = ranges(offsets(k)[:-1][unit], k[unit])
        width = np.diff(np.concatenate(([0], e)))[pick]
        tokens.append((ids[pick], np.cumsum(width), k[unit]))
    (ia, ea, ka), (ib, eb, kb) = tokens
    got = align_parts([ia, ib], [ea, eb], [ka, kb])
    per_unit = {c: np.zeros(n, np.int64) for c in FIGURES}
    for c, v in zip(FIGURES, (ka, kb, got["groups"], got["links"])):
        per_unit[c][unit] = v
    text = pa.array([""] * n, pa.large_string())
    if len(unit):
        where = np.full(n, -1, np.int64)
        where[unit] = np.arange(len(unit))
        text = pc.fill_null(group_strings(got, ia, ib).take(pa.array(where, mask=where < 0)), "")
    doc_at = np.searchsorted(starts, text_starts)
    valid = (sums((~ok[codes]).astype(np.int64), doc_at) == 0) & (size > 0)
    figures = {c: np.where(valid, sums(v[codes], doc_at), 0) for c, v in per_unit.items()}
    whole = pc.binary_join(lists(doc_at, text.take(pa.array(codes))), pa.scalar(";", pa.large_string()))
    digests = [hashlib.sha256(s.as_buffer()).hexdigest() if v else "" for s, v in zip(whole, valid)]
    uses = np.bincount(codes[np.repeat(valid, np.diff(doc_at))], minlength=n)
    key = (got["link_a"].astype(np.int64) << 32) | got["link_b"]
    ix, pairs = pd.factorize(key)
    # below 2 ** 53, so sums of doubles are exact
    counts = np.bincount(ix, np.repeat(uses[unit], got["links"]), len(pairs)).astype(np.int64)
    return {"figures": figures, "digests": digests, "codes": codes, "n_docs": n_docs,
            "stretches": np.where(valid, np.diff(doc_at), 0), "doc_at": doc_at, "valid": valid,
            "links": per_unit["n_links"], "link_ix": ix.astype(np.int32), "pairs": pairs, "counts": counts}


_PAIRS: dict = {}


def _pair(spec) -> Pair:
    key = hash(spec.value)
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*spec.value)
    return _PAIRS[key]


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _slice_table(df: DataFrame, spec, slice_bytes: int) -> DataFrame:
    """One row per slice: ``slice`` id, ``docs`` (the columns of ``df`` but the
    text, and the figures), and the arrays of ``encode_slice`` as bytes."""
    carried = [f for f in df.schema.fields if f.name != "text"]
    doc = T.StructType(carried + [T.StructField(c, T.LongType()) for c in FIGURES]
                       + [T.StructField("groups_sha256", T.StringType())])
    blobs = ["codes", "stretches", "links", "link_ix", "pairs", "counts"]
    schema = T.StructType([T.StructField("slice", T.StringType()), T.StructField("docs", T.ArrayType(doc))]
                          + [T.StructField(b, T.BinaryType()) for b in blobs])
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(spec)
        for t in slices(batches, "text", slice_bytes):
            t = t.combine_chunks()
            got = encode_slice([b or b"" for b in t.column("text").cast(pa.large_binary()).to_pylist()], pair)
            keep = np.repeat(got["valid"], np.diff(got["doc_at"]))
            got["codes"] = got["codes"][keep]
            cols = [t.column(c).combine_chunks() for c in names]
            cols += [pa.array(got["figures"][c]) for c in FIGURES] + [pa.array(got["digests"])]
            rows = pa.StructArray.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols],
                                              names + FIGURES + ["groups_sha256"])
            docs = pa.ListArray.from_arrays(pa.array([0, got["n_docs"]], pa.int32()), rows)
            data = [pa.array([got[b].tobytes()], pa.binary()) for b in blobs]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), docs, *data], ["slice", "docs", *blobs])
    return df.mapInArrow(run, schema)


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for p, c in zip(b.column("pairs"), b.column("counts")):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64)) for x in (p, c)], ["pair", "n"])


def _floor(pairs: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` pairs have that
    count or more, from one number per power."""
    sizes = {r["b"]: r["n"] for r in pairs.groupBy(F.length(F.bin("n")).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, floor = 0, 1 << 62
    for b in sorted(sizes, reverse=True):
        total += sizes[b]
        if total > limit:
            break
        floor = 1 << (b - 1)
    return 1 if total <= limit else floor


def align_tokenizers(df: DataFrame, text: str = "text", vocabularies: tuple[str, str] | None = None,
                     slice_bytes: int = SLICE_BYTES, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``df`` without its text, plus ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``groups_sha256``, ``n_best`` and ``count_sum``; columns of
    ``df`` with these names are kept under a leading underscore."""
    spark: SparkSession = df.sparkSession
    path_a, path_b = vocabularies or default_vocabularies()
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        spec = spark.sparkContext.broadcast((a.read(), b.read()))
    own = {c.lower() for c in (*FIGURES, "groups_sha256", "n_best", "count_sum", text)}
    carried = [c for c in df.columns if c.lower() not in own]
    inner = df.select(F.col(text).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])
    sliced = materialize_as(_slice_table(inner, spec, slice_bytes), "aligned-slices", {
        "parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1})
    pairs = materialize_as(
        sliced.select("pairs", "counts").mapInArrow(_pair_rows, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 0"), "aligned-pairs")
    # one row per B id; the pair's low half is B's id
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = pairs.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    judged = pairs.join(top, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    floor = _floor(pairs, broadcast_pairs)
    common = judged.filter(F.col("n") >= floor).toArrow().combine_chunks().sort_by("pair")
    shared = spark.sparkContext.broadcast(tuple(
        common.column(c).to_numpy() for c in ("pair", "n", "best")))

    def look_up(row) -> tuple:
        """Per distinct pair of a slice: known, count, best."""
        keys, n, best = shared.value
        pairs = np.frombuffer(row["pairs"], np.int64)
        if not len(keys) or not len(pairs):
            z = np.zeros(len(pairs), np.int64)
            return pairs, z.astype(bool), z, z
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        known = keys[at] == pairs
        return pairs, known, np.where(known, n[at], 0), np.where(known, best[at], False).astype(np.int64)

    def arrays(row) -> tuple:
        return tuple(np.frombuffer(row[c], t) for c, t in (
            ("codes", np.int32), ("stretches", np.int64), ("links", np.int64), ("link_ix", np.int32)))

    inner_doc = sliced.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("slice", T.StringType()), T.StructField("at", T.LongType()),
                           T.StructField("doc", inner_doc), T.StructField("n_best", T.LongType()),
                           T.StructField("count_sum", T.LongType())])

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in ("slice", "codes", "stretches", "links", "link_ix", "pairs")}
                codes, stretches, links, ix = arrays(row)
                _, _, n, best = look_up(row)
                at, docs = offsets(links), offsets(stretches)
                total, wins = (sums(sums(v[ix], at)[codes], docs) for v in (n, best))
                doc = b.column("docs")[i].values
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["slice"]] * len(doc)), pa.array(np.arange(len(doc))), doc, pa.array(wins), pa.array(total)],
                    ["slice", "at", "doc", "n_best", "count_sum"])

    def rare_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in ("slice", "codes", "stretches", "links", "link_ix", "pairs")}
                codes, stretches, links, ix = arrays(row)
                pairs, known, _, _ = look_up(row)
                rare = ~known[ix]
                kept = sums(rare.astype(np.int64), offsets(links))
                rare_ix = ix[rare]
                pick = ranges(offsets(kept)[:-1][codes], kept[codes])
                doc = np.repeat(np.repeat(np.arange(len(stretches)), stretches), kept[codes])
                both, n = np.unique(doc * len(pairs) + rare_ix[pick], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["slice"]] * len(both)), pa.array(both // max(len(pairs), 1)),
                     pa.array(pairs[both % max(len(pairs), 1)]), pa.array(n)], ["slice", "at", "pair", "links"])

    blobs = ["slice", "codes", "stretches", "links", "link_ix", "pairs"]
    out = sliced.select("docs", *blobs).mapInArrow(figures, schema)
    if floor > 1:
        extra = (sliced.select(*blobs).mapInArrow(rare_links, "slice string, at long, pair long, links long")
                 .join(judged.filter(F.col("n") < floor), "pair")
                 .groupBy("slice", "at").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
                                             F.sum(F.col("links") * F.col("n")).alias("more_sum")))
        out = out.join(extra, ["slice", "at"], "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return out.select(*[F.col("doc")[f"c{i}"].alias(c) for i, c in enumerate(carried)],
                      *[F.col("doc")[c].alias(c) for c in FIGURES + ["groups_sha256"]], "n_best", "count_sum")
