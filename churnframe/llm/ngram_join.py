"""Operator 6, n-gram Jaccard self-join by token-combination prefixes.

A document's set holds its distinct ``k``-word shingles (hashed to 64 bits).
Two documents link when ``100 * |intersection| >= 80 * |union|``.  Steps, all
exact:

1. *Equal sets collapse* to one representative by a 128-bit fingerprint.
2. *Extended prefixes.*  Under any fixed order of shingles, two linked sets
   share the first ``k`` of their common shingles within prefixes of length
   ``n - ceil(0.8 n) + k``.  A first pass in hash order keeps the sets of
   which enough prefix shingles occur in another prefix.
3. For those, shingles are ordered by rarity.  Shingles in no other set come
   first and need no index; a set with fewer than ``0.8 n`` others goes.
4. *Signatures.*  A rare shingle of the extended prefix is indexed by itself;
   frequent ones by two-token combinations of neighbours at distance 1 and 2.
   Linked sets differ in at most ``n // 4`` shingles, and only a gap with two
   of them separates neighbours, so of the first ``k = n // 8 + 2`` common
   shingles two at least are such neighbours in both sets (pigeonhole).
5. *Sketches.*  Each set has the parities of its shingles in 512 buckets.  Sets
   that differ in ``d`` shingles differ in at most ``d`` parities, and linked
   ones in at most ``(n + m) / 9``; a pair beyond that is never a row.
6. *Stars before pairs.*  Groups are first joined to one leader each and
   verified, in rounds with other leaders; only sets in different components
   are paired afterwards, so groups of thousands of near copies do not expand
   into all their pairs.  A pair is emitted once per run of common signatures.
7. Every candidate is verified on the whole sets.

Defined results: null, empty or blank text has an empty set and links with
nothing; fewer than ``k`` words make one shingle; rows that repeat a
``doc_id`` count as one document; a null ``doc_id`` takes no part and has a
null component; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import materialize_as, maybe_broadcast
from churnframe.llm.components import connected_components
from churnframe.llm.wordhash import mix, rows_shingles, slices
from churnframe.session import free_shuffles, release

SHINGLE = 5
#: similarity as a fraction, 80 / 100
NUM, DEN = 80, 100
#: a shingle in more sets than this is of the frequent class
FREQUENT = 16
#: earlier signatures carried with each entry to skip repeated pairs
RUN = 4
MIN_HASHES = 3
#: sets are broadcast for verification only if they are counted and hold at
#: most this many tokens (8 bytes each); beyond it the pairs are shuffled
BROADCAST_TOKENS = 1_000_000
#: leaders are tried until a round finds less than this share of the most links
ROUND_FINDS = 0.05
#: 64-bit words of a sketch
SKETCH_WORDS = 8


def _need(n: Column) -> Column:
    """ceil(0.8 n) in integers."""
    return F.floor((n * NUM + (DEN - 1)) / DEN).cast("long")



def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each bucket of their lowest bits."""
    size = 64 * SKETCH_WORDS
    counts = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _sets(docs: DataFrame, k: int, prefix_only: bool) -> DataFrame:
    """(node, n, f1, f2, toks, sk): fingerprints, either the hash-order extended
    prefix or the whole set, ascending, and the sketch of a whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in slices(b.column(1)):
                n, f1, f2, toks, sk = [], [], [], [], []
                for s in rows_shingles(texts, k):
                    size = len(s)
                    n.append(size)
                    f1.append(np.bitwise_xor.reduce(mix(s)) if size else np.uint64(0))
                    f2.append((mix(s ^ np.uint64(0x5851F42D4C957F2D))).sum(dtype=np.uint64))
                    if prefix_only:
                        s = s[:size - (size * NUM + DEN - 1) // DEN + (size + 9) // 10]
                    sk.append(None if prefix_only else _sketch(s))
                    toks.append(s.view(np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in toks])]).astype(np.int32)
                flat = np.concatenate(toks) if toks else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array(n, pa.int64()),
                     pa.array(np.array(f1, np.uint64).view(np.int64)),
                     pa.array(np.array(f2, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(sk, pa.list_(pa.int64()))],
                    names=["node", "n", "f1", "f2", "toks", "sk"])
    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"node {kind}, n long, f1 long, f2 long, toks array<long>, sk array<long>")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the (u, v) pairs whose sets link.  A node may have several
    sets; ``toks`` may lack shingles that no other set has."""
    a = sets.select(F.col("node").alias("u"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    b = sets.select(F.col("node").alias("v"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    if (sets.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_TOKENS:
        a, b = F.broadcast(a), F.broadcast(b)
    both = pairs.join(a, "u").join(b, "v")
    common = F.size(F.array_intersect("ta", "tb"))
    return both.filter((F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM)
                       & (common * DEN >= (F.col("na") + F.col("nb") - common) * NUM)).select("u", "v")


def _label(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``nodes``."""
    comp = connected_components(edges)
    out = (nodes.select("node").distinct().join(comp, "node", "left")
                .select("node", F.coalesce("component", "node").alias("comp")))
    return materialize_as(out, "ngram-comp")


def _viable(prefixes: DataFrame) -> DataFrame:
    """Nodes enough of whose hash-order prefix occurs in another prefix."""
    entries = prefixes.select(F.explode("toks").alias("tok"), "node", "n")
    shared = entries.groupBy("tok").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("tok")
    hits = entries.join(shared, "tok").groupBy("node", "n").agg(F.count(F.lit(1)).alias("c"))
    partner = _need(F.col("n"))  # the smallest set that can link with one of n
    return hits.filter(F.col("c") >= F.floor((partner + 9) / 10)).select("node").distinct()


def _by_rarity(sets: DataFrame) -> DataFrame:
    """(node, f1, n, toks, dfs): shingles that occur in another set, ascending
    by their number of sets, for sets that keep at least 0.8 n of them."""
    entries = sets.select("node", "f1", "n", F.explode("toks").alias("tok"))
    df = entries.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rows = (entries.join(df, "tok").groupBy("node", "f1", "n")
                   .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("r")))
    return (rows.filter(F.size("r") >= _need(F.col("n")))
                .select("node", "f1", "n", F.col("r.tok").alias("toks"), F.col("r.df").alias("dfs")))


def _signatures(ranked: DataFrame) -> DataFrame:
    """(sig, node, n, s, p, prev): index entries of each set's extended prefix;
    ``p`` is the first token's position in the whole set, rarest first."""
    n, s = F.col("n"), F.size("toks")
    length = n - _need(n) + F.floor(n / 8) + 2 - (n - s)  # less the unshared ones in front
    taken = F.greatest(F.lit(0), F.least(length, s)).cast("int")
    cut = ranked.select("node", "n", s.alias("s"), F.slice("toks", 1, taken).alias("t"),
                        F.slice("dfs", 1, taken).alias("d")).filter(F.size("t") > 0)
    t = F.col("t")
    rare = F.size(F.filter("d", lambda d: d <= FREQUENT))
    cut = cut.withColumn("rare", rare)

    def sigs(x: Column, i: Column) -> Column:
        at = F.col("n") - F.col("s") + i
        one = lambda h: F.struct(h.alias("sig"), at.alias("p"))
        pair = lambda j: F.when(j < F.size(t), one(F.xxhash64(x, F.get(t, j))))
        return F.when(i < F.col("rare"), F.array(one(F.xxhash64(x)))).otherwise(
            F.array_compact(F.array(pair(i + 1), pair(i + 2))))

    listed = cut.select("node", "n", "s", F.flatten(F.transform(t, sigs)).alias("sigs"))
    before = lambda i: F.slice(F.col("sigs.sig"), F.greatest(F.lit(1), i - RUN + 1), F.least(F.lit(RUN), i))
    entry = F.transform("sigs", lambda x, i: F.struct(x["sig"].alias("sig"), x["p"].alias("p"), before(i).alias("prev")))
    return (listed.select("node", "n", "s", F.explode_outer(entry).alias("e")).filter("e IS NOT NULL")
                  .select("e.sig", "node", "n", "s", "e.p", "e.prev"))


def _reach(na: Column, sa: Column, pa: Column, nb: Column, sb: Column, pb: Column) -> Column:
    """Length filter, and the largest overlap that the shared shingles and the
    shingles before and after the matching positions allow."""
    most = F.least(sa, sb, F.least(pa, pb) + F.least(na - pa, nb - pb))
    return ((F.least(na, nb) * DEN >= F.greatest(na, nb) * NUM)
            & (most * (NUM + DEN) >= (na + nb) * NUM))


def _alike(na: Column, ka: Column, nb: Column, kb: Column) -> Column:
    """Whether the sketches of two sets differ in no more places than linked
    sets of these sizes can differ in shingles."""
    apart = sum((F.bit_count(F.get(ka, j).bitwiseXOR(F.get(kb, j))) for j in range(SKETCH_WORDS)), F.lit(0))
    return apart * (DEN + NUM) <= (na + nb) * (DEN - NUM)


def _crossing(entries: DataFrame, comp: DataFrame) -> DataFrame:
    """Entries, with components, of signatures held by several components."""
    joined = entries.join(comp, "node")
    cross = joined.groupBy("sig").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b")
    return joined.join(cross.select("sig"), "sig")


def _min_hash_stars(ranked: DataFrame) -> DataFrame:
    """Candidate (u, v): each set and the first node with the same minimum."""
    mins = F.array(*[F.struct(F.lit(j).alias("j"), F.array_min(F.transform(
        "toks", lambda x, j=j: F.xxhash64(x, F.lit(j)))).alias("h")) for j in range(MIN_HASHES)])
    rows = ranked.select("node", F.explode(mins).alias("m")).select("node", "m.j", "m.h")
    low = rows.groupBy("j", "h").agg(F.min("node").alias("v"))
    return rows.join(low, ["j", "h"]).filter("node <> v").select(F.col("node").alias("u"), "v").distinct()


def _leader_stars(cross: DataFrame, sketches: DataFrame, turn: int) -> DataFrame:
    """Candidate (u, v): each entry's node and its signature's leader, which
    changes from round to round; one leader of each component for a node."""
    lead = cross.groupBy("sig").agg(F.min(F.struct(
        F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("v"), F.col("comp").alias("vc"),
        F.col("n").alias("n"), F.col("s").alias("s"), F.col("p").alias("p"))).alias("l"))
    near = _reach(*[F.col(c) for c in ("n", "s", "p", "l.n", "l.s", "l.p")])
    met = cross.join(lead, "sig").filter((F.col("comp") != F.col("l.vc")) & near).select(
        F.col("node").alias("u"), F.col("l.v").alias("v"), F.col("l.vc").alias("vc"), F.col("n").alias("na"), F.col("l.n").alias("nb"))
    both = (met.join(sketches.toDF("u", "ka"), "u").join(sketches.toDF("v", "kb"), "v")
               .filter(_alike(*map(F.col, ("na", "ka", "nb", "kb")))))
    return both.groupBy("u", "vc").agg(F.min("v").alias("v")).select("u", "v")


def _cross_pairs(cross: DataFrame) -> DataFrame:
    a = cross.select("sig", F.col("node").alias("u"), F.col("n").alias("na"), F.col("s").alias("sa"),
                     F.col("comp").alias("ca"), F.col("p").alias("pa"), F.col("prev").alias("ra"),
                     F.col("sk").alias("ka"))
    b = cross.select("sig", F.col("node").alias("v"), F.col("n").alias("nb"), F.col("s").alias("sb"),
                     F.col("comp").alias("cb"), F.col("p").alias("pb"), F.col("prev").alias("rb"),
                     F.col("sk").alias("kb"))
    cond = ((a["sig"] == b["sig"]) & (F.col("u") < F.col("v")) & (F.col("ca") != F.col("cb"))
            & _reach(*map(F.col, ("na", "sa", "pa", "nb", "sb", "pb")))
            & _alike(*map(F.col, ("na", "ka", "nb", "kb"))) & ~F.arrays_overlap("ra", "rb"))
    return a.join(b, cond).select("u", "v").distinct()


def similar_documents(docs: DataFrame, text: str = "text", key: str = "doc_id",
                      k: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(sets, components): ``sets`` has (node, n, f1, f2) per row of ``docs``;
    ``components`` has (node, component) of every document that shares its
    component with another."""
    pair = docs.select(F.col(key).alias("node"), F.col(text).alias("text"))
    prefixes = materialize_as(_sets(pair, k, prefix_only=True).drop("sk"), "ngram-prefix")
    keyed = prefixes.filter("n > 0 AND node IS NOT NULL")
    # equal sets: every document points to the smallest one
    low = materialize_as(keyed.groupBy("f1", "f2").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("c"))
                         .filter("c > 1").drop("c"), "ngram-equal")
    copies = materialize_as(keyed.select("node", "f1", "f2").join(maybe_broadcast(low), ["f1", "f2"])
                            .filter("node <> rep").select("node", "rep", "f1").distinct(), "ngram-copies")
    small = maybe_broadcast(copies.select("node", "f1"))
    reps = keyed.join(small, ["node", "f1"], "left_anti")

    viable = maybe_broadcast(materialize_as(_viable(reps), "ngram-viable"))
    whole = _sets(pair.join(viable, "node", "left_semi"), k, prefix_only=False).filter("n > 0")
    whole = whole.join(small, ["node", "f1"], "left_anti").dropDuplicates(["node", "f1", "f2"])
    sets = materialize_as(whole, "ngram-sets")
    free_shuffles(docs.sparkSession)
    ranked = materialize_as(_by_rarity(sets), "ngram-ranked")
    sketches = materialize_as(sets.select("node", "sk"), "ngram-sketches")
    release(sets)

    edges = materialize_as(_links(_min_hash_stars(ranked), ranked), "ngram-links")
    entries = materialize_as(_signatures(ranked), "ngram-signatures")
    free_shuffles(docs.sparkSession)
    comp = _label(ranked, edges)
    cross = materialize_as(_crossing(entries, comp).drop("comp"), "ngram-cross")
    release(entries)
    # a node with several sets gets an entry for each of its sketches
    known = maybe_broadcast(sketches)
    found, most, turn = edges.count(), 1, 0
    while found > ROUND_FINDS * most or turn == 0:
        most = max(most, found)
        labelled = cross.join(maybe_broadcast(comp), "node")
        new = materialize_as(_links(_leader_stars(labelled, known, turn), ranked), "ngram-links")
        free_shuffles(docs.sparkSession)
        found, turn, old = new.count(), turn + 1, comp
        edges = edges.union(new)
        comp = _label(ranked, edges)
        release(old)
    bare = cross
    cross = materialize_as(_crossing(bare, maybe_broadcast(comp)).join(known, "node"), "ngram-sketched")
    release(bare)
    free_shuffles(docs.sparkSession)
    last = materialize_as(_links(_cross_pairs(cross), ranked), "ngram-links")
    release(cross)
    same = copies.select(F.col("node").alias("u"), F.col("rep").alias("v"))
    # a document with several rows has several sets: its copies tie them
    return prefixes.drop("toks"), connected_components(edges.union(last).union(same))


def with_components(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_shingles``, ``component_id``."""
    sets, comp = similar_documents(docs, text, key, k)
    return (sets.select(F.col("node"), F.col("n").alias("n_shingles")).join(comp, "node", "left")
                .select(F.col("node").alias(key), "n_shingles",
                        F.coalesce("component", "node").alias("component_id")))


def keep_one_per_group(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` without those that have a smaller document in their
    component; of rows that repeat a document one stays.  Rows with a null key
    stay."""
    sets, comp = similar_documents(docs, text, key, k)
    drop = materialize_as(comp.filter("node <> component").select(F.col("node").alias(key)), "ngram-drop")
    kept = docs.join(maybe_broadcast(drop), key, "left_anti").select(*docs.columns)
    twice = materialize_as(sets.filter("node IS NOT NULL").groupBy(F.col("node").alias(key)).count()
                           .filter("count > 1").select(key), "ngram-repeated")
    if twice.isEmpty():
        return kept
    twice = maybe_broadcast(twice)  # only rows that repeat an id move
    once = kept.join(twice, key, "left_anti").select(*docs.columns)
    return once.union(kept.join(twice, key, "left_semi").select(*docs.columns).dropDuplicates([key]))
