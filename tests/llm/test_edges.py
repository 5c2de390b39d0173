"""Nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import pytest
from pyspark.sql import functions as F


def _ids(df):
    return sorted((r[0] is None, r[0]) for r in df.select("doc_id").collect())


OWN = {"quality": "base_failed kept".split(), "bpe": ["bpe_ids"], "pii": ["all_spans"], "secrets": ["all_spans"],
       "lang": ["lang_pred"], "ordinal": ["expected_grade"]}


def _run(name, df):
    if name == "quality":
        from churnframe.llm.quality_rules import judge
        return judge(df, carry=["doc_id", "k1"])
    if name == "bpe":
        from churnframe.llm.bpe import encode_decode
        return encode_decode(df)
    if name == "pii":
        from churnframe.llm.pii import detect
        return detect(df)
    if name == "secrets":
        from churnframe.llm.secrets_scan import scan
        return scan(df)
    if name == "lang":
        from churnframe.llm.bigru import predict, train
        return predict(df, train(df, per_lang=5, steps=5))
    from churnframe.llm.ordinal import score, train
    labels = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("g"))
    return score(df, train(df, labels, F.col("g"), per_grade=5))


@pytest.mark.parametrize("name", sorted(OWN))
def test_row_operators_keep_every_row(edge, empty, name):
    out = _run(name, edge)
    assert set(OWN[name]) <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))
    assert _ids(out) == _ids(edge)
    assert _run(name, empty).count() == 0


def test_null_text_results(edge):
    from churnframe.llm.bpe import encode_decode
    from churnframe.llm.quality_rules import judge
    row = encode_decode(edge).filter("doc_id = 1").first()
    assert (row.bpe_n_tokens, bytes(row.bpe_ids), row.bpe_decoded) == (0, b"", "")
    q = judge(edge, carry=["doc_id"]).filter("doc_id = 1").first()
    assert q.n_words == 0 and q.base_failed and not q.kept


def test_language_of_text_without_letters(spark):
    from churnframe.llm.bigru import predict
    df = spark.createDataFrame([(1, "12 34"), (2, None)], "doc_id long, text string")
    assert {r.lang_pred for r in predict(df, None).collect()} == {"und"}


def test_ngram_join_edges(edge, empty):
    from churnframe.llm.ngram_join import keep_one_per_group, with_components
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in with_components(edge).collect()}
    assert (1, 0, 1) in rows and (3, 0, 3) in rows and (4, 1, 4) in rows and (None, 7, None) in rows
    assert (5, 29996, 5) in rows
    assert with_components(empty).count() == 0
    kept = keep_one_per_group(edge)
    assert kept.columns == edge.columns and kept.count() == 6  # the repeated row goes
    assert keep_one_per_group(empty).count() == 0


def test_line_dedup_edges(edge, empty):
    from churnframe.llm.line_dedup import dedup_lines
    out = dedup_lines(edge)
    assert out.columns == edge.columns
    assert _ids(out) == _ids(edge)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[3] == " \n\t " and texts[4] == "one two three"
    assert dedup_lines(empty).count() == 0


def test_decontamination_edges(spark, edge, empty):
    from churnframe.llm.decontaminate import contaminated_documents, remove_contaminated
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, "one two three"),
                                   (4, " ".join(f"w{i}" for i in range(100, 140)))], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.similarity, r.word) for r in contaminated_documents(edge, items).collect())
    assert got == [(4, 3, 1.0, 0), (5, 4, 1.0, 100)]
    out = remove_contaminated(edge, items)
    assert out.columns == edge.columns
    assert _ids(out) == [(False, 1), (False, 2), (False, 3), (True, None)]
    assert remove_contaminated(empty, items).count() == 0
    assert contaminated_documents(edge, items.limit(0)).count() == 0


def test_html_edges(spark):
    from churnframe.llm.html_template import extract
    rows = [(1, None, None), (2, "http://a/x", ""), (3, "http://a/x", "<p>a<p>b &lt; c"), (3, "http://a/x", "<p>a<p>b &lt; c"),
            (4, "no url", "<article>" + "<p>long text</p>" * 20000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn(
        "slots", F.lit(2))
    got = {r.page_id: r.main_text for r in extract(df).collect()}
    assert got == {1: "", 2: "", 3: "a\nb < c", 4: "\n".join(["long text"] * 20000)}
    assert extract(df.limit(0)).count() == 0


def test_pipeline_edges(spark, sf, edge, empty):
    import corpus_pipeline
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for df, n in ((docs, 2), (empty.select(*docs.columns), 0)):
        for name, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf)
            if name != "bpe":
                assert df.columns == docs.columns and df.dtypes == docs.dtypes
        assert df.count() == n  # the long text and the row without an id
