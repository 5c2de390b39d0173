"""Operator 3, benchmark decontamination by SimHash of item-sized windows.

For every benchmark item, document windows of the item's length in words are
fingerprinted (64-bit SimHash over the window's five-word shingles, lower
case, weighted by their counts).  Fingerprints are compared through a
multi-index: 64 bits in ``BLOCKS`` blocks; two fingerprints within ``RADIUS``
bits agree in some block up to ``RADIUS // BLOCKS`` flipped bits, so the item
side is indexed under all those variants and every fingerprint within the
radius is found.  Candidates are verified by their exact weighted Jaccard
similarity (shingles with their counts), 0.8 or more.

Only windows that can reach 0.8 are fingerprinted, whatever the order of their
shingles: those that hold, at any place, as many of the item's shingles as 0.8
takes.  Of equally similar windows the one that lines up with the item in some
shingle is reported, then the first.

Items are broadcast only if their shingles have been counted and are few;
else they are joined by shuffle.  Built-in column functions only.

Defined results: null or blank texts and items have no shingles and match
nothing; a text shorter than the item is one window; an item of fewer than five
words is one shingle of its own width, found in texts of any length; equal texts are examined once; rows with a null id take part
and are returned with the null id; an empty table gives an empty result;
extra columns are passed through by ``remove_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import fresh, materialize_as, maybe_broadcast

SHINGLE = 5
NUM, DEN = 80, 100
SPACE_RUN = r"[\x20\x09-\x0D]+"
BITS, BLOCKS, RADIUS = 64, 5, 19
#: first bit and width of each block
LAYOUT = tuple((b * BITS // BLOCKS, (b + 1) * BITS // BLOCKS - b * BITS // BLOCKS) for b in range(BLOCKS))


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACE_RUN), "")


def _shingles(h: Column, k: int = SHINGLE) -> Column:
    """Shingle hashes, in order, of an array of word hashes."""
    return (F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(
                *[F.get(h, i + j) for j in range(k)])))
            .otherwise(F.slice(F.array(F.xxhash64(h)), F.lit(1), F.least(F.size(h), F.lit(1)))))


def _simhash(shingles: Column) -> Column:
    """Bit b is set if more than half of the shingles (with repeats) have it."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0).cast("bigint"), lambda a, x: a + F.call_function(
            "shiftrightunsigned", x, b).bitwiseAND(F.lit(1).cast("bigint")))
        return F.when(ones * 2 > F.size(shingles), F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit),
                       F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(x))


def _counted(shingles: Column) -> Column:
    """The multiset as a set: each shingle hashed with its occurrence number."""
    s = F.sort_array(shingles)
    return F.transform(s, lambda x, i: F.xxhash64(x, i - F.array_position(s, x)))


def _block(fp: Column, b: int) -> Column:
    first, width = LAYOUT[b]
    return F.call_function("shiftrightunsigned", fp, F.lit(first)).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _item_keys(items: DataFrame) -> DataFrame:
    """(size, b, value, item, fp): every value of every block within reach."""
    rows = None
    for b, (_, width) in enumerate(LAYOUT):
        masks = F.transform(F.sequence(F.lit(0), F.lit((1 << width) - 1)), lambda m: m.cast("bigint"))
        near = F.filter(masks, lambda m: F.bit_count(m) <= RADIUS // BLOCKS)
        part = items.select("size", F.lit(b).alias("b"), "item", "fp", _block(F.col("fp"), b).alias("v"),
                            F.explode(near).alias("m")).select(
            "size", "b", F.col("v").bitwiseXOR(F.col("m")).alias("value"), "item", "fp")
        rows = part if rows is None else rows.union(part)
    return rows


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(k1, k2, item, similarity, word): per different text (named by two
    hashes, see ``text_key``) and item, the best window and its first word."""
    listed = (items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text"))
                   .withColumn("w", _words("text")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
                   .withColumn("sh", _shingles(F.col("h"))).filter(F.size("sh") > 0)
                   .select("item", F.size("w").alias("size"), "sh")
                   .withColumn("fp", _simhash(F.col("sh"))).withColumn("bag", _counted(F.col("sh"))))
    listed = materialize_as(listed, "bench-items")
    spots = materialize_as(listed.select("item", "size", F.posexplode("sh").alias("at", "s")).distinct(), "bench-shingles")
    # items shorter than a shingle have widths of their own
    short = sorted(r["size"] for r in listed.filter(F.col("size") < SHINGLE).select("size").distinct().collect())
    base = docs.select(F.col(text).alias("text"))
    hashed = base.withColumn("w", _words("text")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))

    def laid(width: int, sh: Column) -> DataFrame:
        # everything but the shingles is made small before the explode
        return (hashed.withColumn("sh", sh).select(*text_key("text"), F.size("w").alias("n"), "sh")
                      .select("k1", "k2", "n", F.lit(width).alias("width"), F.posexplode_outer("sh").alias("pos", "s"))
                      .filter("s IS NOT NULL"))
    where = laid(SHINGLE, _shingles(F.col("h")))
    for k in short:
        where = where.union(laid(k, F.when(F.size("h") >= k, F.transform(
            F.sequence(F.lit(0), F.size("h") - k), lambda i: F.xxhash64(F.slice("h", i + 1, F.lit(k)))))))
    spread = spots.withColumn("width", F.least(F.lit(SHINGLE), "size"))
    last = F.greatest(F.lit(0), F.col("n") - F.col("size"))
    common = (where.join(maybe_broadcast(spread), ["s", "width"])
                   .groupBy("k1", "k2", "n", "item", "size")
                   .agg(F.sort_array(F.collect_set("pos")).alias("found"), F.collect_set(
                       F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("n") - F.col("size")))).alias("lined")))
    # shingles of the item and of a window, and how many must be common
    of_item = F.greatest(F.lit(1), F.col("size") - (SHINGLE - 1))
    of_window = F.greatest(F.lit(1), F.least("size", "n") - (SHINGLE - 1))
    need = F.ceil((of_item + of_window) * NUM / (DEN + NUM)).cast("int")
    # every start whose window holds that many, by the runs of so many in a row
    runs = F.transform(F.sequence(F.lit(0), F.size("found") - F.col("need")), lambda i: F.struct(
        F.greatest(F.lit(0), F.get("found", i + F.col("need") - 1) - F.col("m") + 1).alias("a"),
        F.least(F.get("found", i), last).alias("z")))
    fit = F.transform(F.filter(runs, lambda r: r["a"] <= r["z"]), lambda r: F.sequence(r["a"], r["z"]))
    common = materialize_as(common.withColumn("need", need).withColumn("m", of_window)
                                  .filter(F.size("found") >= F.col("need")), "bench-common")
    starts = (common.select("k1", "k2", "item", "size", "lined", F.explode(F.array_distinct(F.flatten(fit))).alias("start"))
                    .select("k1", "k2", "item", "size", "start", F.array_contains("lined", F.col("start")).alias("lined")))
    starts = materialize_as(starts, "bench-starts")
    wanted = starts.groupBy("k1", "k2").agg(F.collect_set(F.struct("size", "start")).alias("spots"))
    again = (base.select(*text_key("text"), "text").join(maybe_broadcast(materialize_as(wanted, "bench-wanted")), ["k1", "k2"])
                 .dropDuplicates(["k1", "k2"])
                 .withColumn("w", _words("text")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x))))
    windows = (again.select("k1", "k2", F.explode_outer(F.transform("spots", lambda x: F.struct(
                   x["size"].alias("size"), x["start"].alias("start"),
                   F.slice("h", x["start"] + 1, x["size"]).alias("h")))).alias("x"))
                    .select("k1", "k2", "x.size", "x.start", _shingles(F.col("x.h")).alias("sh"))
                    .withColumn("fp", _simhash(F.col("sh"))).withColumn("bag", _counted(F.col("sh"))))
    windows = materialize_as(windows.drop("sh"), "bench-windows")
    probes = windows.select("k1", "k2", "size", "start", "fp", F.explode(F.array(*[
        F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("value")) for b in range(BLOCKS)])).alias("p"))
    probes = probes.select("k1", "k2", "size", "start", "fp", "p.b", "p.value")
    keys = materialize_as(_item_keys(listed), "bench-keys").withColumnRenamed("fp", "ifp")
    near = (probes.join(maybe_broadcast(keys, 1_000_000), ["size", "b", "value"])
                  .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
                  .select("k1", "k2", "size", "start", "item").distinct())
    bags = maybe_broadcast(listed.select("item", "size", F.col("bag").alias("ibag")))
    near = near.join(starts, ["k1", "k2", "size", "start", "item"])
    both = near.join(windows.select("k1", "k2", "size", "start", "bag"), ["k1", "k2", "size", "start"]).join(
        bags, ["item", "size"])
    o, total = F.size(F.array_intersect("bag", "ibag")), F.size("bag") + F.size("ibag")
    return (both.withColumn("o", o).withColumn("u", total - F.col("o")).filter(F.col("o") * DEN >= F.col("u") * NUM)
                .groupBy("k1", "k2", "item")
                .agg(F.max(F.struct((F.col("o") / F.col("u")).alias("similarity"), "lined", (-F.col("start")).alias("back"))).alias("m"))
                .select("k1", "k2", "item", "m.similarity", (-F.col("m.back")).alias("word")))


def text_key(text: str) -> list[Column]:
    """Two hashes (96 bits) that name a text."""
    return [F.xxhash64(text).alias("k1"), F.hash(text).alias("k2")]


def contaminated_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                           item_key: str = "item_id") -> DataFrame:
    """One row per document and item found in it: ``key``, ``item_key``,
    ``similarity`` and the window's first ``word``."""
    found = maybe_broadcast(materialize_as(contaminated(docs, items, text, item_key), "bench-found"))
    named = docs.select(F.col(key), F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"))
    return (named.join(found, ["k1", "k2"])
                 .groupBy(key, F.col("item").alias(item_key))
                 .agg(F.max(F.struct("similarity", (-F.col("word")).alias("back"))).alias("m"))
                 .select(key, item_key, "m.similarity", (-F.col("m.back")).cast("long").alias("word")))


def remove_contaminated(docs: DataFrame, items: DataFrame, text: str = "text",
                        item_key: str = "item_id") -> DataFrame:
    """Rows of ``docs`` whose text holds no benchmark item."""
    a, b = fresh(docs, ["k1", "k2"])
    found = contaminated(docs, items, text, item_key).select(F.col("k1").alias(a), F.col("k2").alias(b)).distinct()
    found = maybe_broadcast(materialize_as(found, "bench-found"))
    return (docs.withColumn(a, F.xxhash64(text)).withColumn(b, F.hash(text))
                .join(found, [a, b], "left_anti").select(*docs.columns))
