"""Items whose parts stand in another order, and items shorter than a shingle."""


def _brute(words, item):
    from collections import Counter

    def bag(w):
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    b, best = bag(item), 0
    for i in range(max(1, len(words) - len(item) + 1)):
        a = bag(words[i:i + len(item)])
        o = sum((a & b).values())
        best = max(best, o / (sum(a.values()) + sum(b.values()) - o))
    return best


def test_rearranged_and_short_items_are_found(spark):
    from churnframe.llm.decontaminate import contaminated_documents
    item = [f"i{k}" for k in range(60)]
    pad = lambda a, n=70: [f"{a}{k}" for k in range(n)]
    docs = {1: pad("a") + item[30:] + item[:30] + pad("b"), 2: pad("c") + item[:30] + ["x"] * 3 + item[30:] + pad("d"),
            3: pad("e") + item[40:] + item[:40], 4: item[50:] + item[:25] + item[25:50], 5: pad("f"),
            6: pad("g") + item[:29] + pad("h", 9) + item[29:], 7: item[30:] + item[:29]}
    items = [(1, " ".join(item)), (2, "g5 g6 g7"), (3, "f9"), (4, "i58 i59 i0 i1")]
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated_documents(
        df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, 1): s for d, w in docs.items() if (s := _brute(w, item)) >= 0.8}
    assert {1, 3, 4} <= {d for d, _ in want} and len(want) < len(docs)
    want |= {(6, 2): 1.0, (5, 3): 1.0, (1, 4): 1.0, (3, 4): 1.0, (4, 4): 1.0, (7, 4): 1.0}
    assert got == want
