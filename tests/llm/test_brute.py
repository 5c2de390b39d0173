"""Operators against plain versions on small fixtures."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import brute_pii
import brute_secrets
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rng():
    return random.Random(17)


def _text(rng, n, vocab=4000):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.mark.parametrize("name", ["op3_simhash_decontamination", "op6_ngram_jaccard", "op7_line_dedup",
                                  "op8_quality_rules"])
def test_query_matches_sql(spark, name):
    from churnframe.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(res.fetchall())


def test_bpe_equals_library(rng):
    from tokenizers import Tokenizer

    from churnframe.llm.bpe import Codec, default_vocabulary
    lib = Tokenizer.from_file(default_vocabulary())
    with open(default_vocabulary(), encoding="utf-8") as f:
        codec = Codec(f.read(), memory=50)
    parts = ["a", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "é", "漢", "😀", "'s", "'ll", "1", "²", "<|endoftext|>",
             "-", "\r\n", "\x00", "the", "ing", "abc" * 40]
    texts = ["", "a" * 3000, " " * 500] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30)))
                                           for _ in range(1500)]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert list(codec.encode(t)) == ids
        assert codec.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_never_merged_over():
    from churnframe.llm.bpe import Codec, default_vocabulary
    with open(default_vocabulary(), encoding="utf-8") as f:
        codec = Codec(f.read())
    for w in (b"ci\xc3\xb3nque", b"xqzjv", b"thewh"):
        assert b"".join(codec.cuts(w)) == w
        assert [i for f in codec.cuts(w) for i in codec.merge(f)] == list(codec.merge(w))


def test_bpe_query_digests(spark):
    from churnframe.llm.bpe import Codec, default_vocabulary
    from churnframe.llm.queries import QUERIES
    with open(default_vocabulary(), encoding="utf-8") as f:
        codec = Codec(f.read())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe_forced_boundaries"](spark, SF).collect():
        ids = list(codec.encode(texts[r.doc_id] or ""))
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_pii_base_spans(rng):
    from churnframe.llm.pii import base_spans
    parts = ["a", "@", ".", "b.c", "@x.com", "1", "12", "255", "256", "-", " ", "+", "(", ")", "4111111111111111",
             "4111 1111-1111 1111", "+1 (988) 555-2485", "٣", "é", "\n", "1.2.3.4", "00", "%", "9" * 20]
    for _ in range(20000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(15)))
        assert base_spans(t) == brute_pii.base(t), t


def test_pii_query_and_added_spans(spark):
    from churnframe.llm import pii
    texts = ["Please call 0171 555 1234 or mail jane [at] example [dot] org, contact Dr. Jane Doe.",
             "My ssn 078-05-1120, card 4111 1111 1111 1111.", "IP 10.0.0.256 and page 12, total 3.50",
             "iban DE89 3704 0044 0532 0130 00 for the account"] * 30 + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r.doc_id: r for r in pii.detect(df).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in rows[i].base_spans] == brute_pii.base(t)
        assert set(rows[i].base_spans) <= set(rows[i].all_spans)
    found = {(pii.KINDS[s.kind], texts[i][s.start:s.end]) for i in range(4) for s in rows[i].all_spans}
    assert {("name", "Jane Doe"), ("email_spelled", "jane [at] example [dot] org"), ("id_number", "078-05-1120"),
            ("bank_account", "DE89 3704 0044 0532 0130 00")} <= found


def test_em_recovers_reliabilities():
    from churnframe.llm.pii import em
    r = np.random.default_rng(0)
    y = r.random(20000) < 0.4
    right = np.array([0.9, 0.8, 0.7, 0.95, 0.6, 0.85, 0.75])
    votes = np.where(r.random((len(y), 7)) < right, y[:, None], ~y[:, None])
    seen = Counter("".join("+" if v else "-" for v in row) for row in votes)
    patterns = sorted(seen)
    q, rates = em(patterns, np.array([seen[p] for p in patterns], float))
    assert np.abs(rates[1, :, 2] - right).max() < 0.03
    prob = dict(zip(patterns, q))
    hit = np.array([prob["".join("+" if v else "-" for v in row)] >= 0.5 for row in votes])
    assert (hit == y).mean() > 0.95


def test_secrets_equal_brute_force(spark, rng):
    import string

    from churnframe.llm import secrets_scan as ss

    def rnd(n, al=string.ascii_letters + string.digits):
        return "".join(rng.choice(al) for _ in range(n))
    parts = ["password=", "token: ", "secret: token: abcdefghijk", 'api_key="', "ApiKey = ", "AKIA", " ", "é", "\n", "'"]
    texts = [None, "", "0" * 40, "123e4567-e89b-12d3-a456-426614174000 " + rnd(30), "AKIAAKIA" + "A" * 10,
             "é" * 5 + rnd(40)]
    for _ in range(150):
        texts.append("".join(rng.choice(parts + [rnd(9), rnd(25), rnd(40), rnd(33, "0123456789abcdef"),
                                                 rnd(30, "0123456789ABCDEF")]) for _ in range(rng.randint(1, 8))))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    added = 0
    for r in ss.scan(df).collect():
        base, spans = brute_secrets.spans(texts[r.id])
        assert [(s.start, s.kind, s.end) for s in r.base_spans] == base
        assert [(s.start, s.kind, s.end) for s in r.all_spans] == spans
        added += len(spans) - len(base)
    assert added > 10


def _components(sets):
    """Brute force: all pairs."""
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_ngram_components_of_near_copy_families(spark, rng):
    from churnframe.llm.ngram_join import with_components
    docs, passage = {}, _text(rng, 60)
    for f in range(6):
        base = _text(rng, 150).split()
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randrange(7)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            docs[len(docs)] = " ".join(w)
    for _ in range(120):
        docs[len(docs)] = _text(rng, rng.randrange(1, 80)) + " " + passage
    docs[len(docs)] = docs[0].upper()
    sets = {}
    for d, t in docs.items():
        w = t.lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in with_components(df).collect()}
    want = _components(sets)
    assert got == {d: (len(sets[d]), want[d]) for d in docs}


def test_connected_components_of_a_chain_and_a_star(spark):
    from churnframe.llm.components import connected_components
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 3)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}}


def test_language_held_out_accuracy(spark):
    from churnframe.llm.queries import QUERIES
    out = QUERIES["op9_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_gradients_of_the_recurrent_network():
    from churnframe.llm.bigru import BiGRU
    r = np.random.default_rng(1)
    net = BiGRU(3, hidden=3)
    data, mask, y = r.integers(97, 101, (6, 5)), np.ones((6, 5), bool), r.integers(0, 3, 5)
    _, grad = net.gradients(data, mask, y)
    for k, w in net.w.items():
        flat = w.reshape(-1)
        for i in np.flatnonzero(np.abs(grad[k].reshape(-1)) > 1e-3)[:8]:
            old = flat[i]
            flat[i] = old + 1e-2
            up = net.gradients(data, mask, y)[0]
            flat[i] = old - 1e-2
            down = net.gradients(data, mask, y)[0]
            flat[i] = old
            assert abs((up - down) / 2e-2 - grad[k].reshape(-1)[i]) < 0.05 * abs(grad[k].reshape(-1)[i]) + 2e-3


def test_ordinal_grades_on_held_out_labels(spark):
    from churnframe.llm.ordinal import score, train
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    model = train(docs, labels.filter("doc_id % 2 = 0"), grade)
    assert np.all(np.diff(model.theta) > 0)
    held = score(docs, model, keep_at=model.keep_at()).join(labels.filter("doc_id % 2 = 1").withColumn("g", grade), "doc_id")
    rows = held.groupBy("g").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.g: r.kept for r in rows}
    assert kept[2] > 0.97 and kept[1] < 0.25 and kept[0] < 0.15


def test_html_articles(spark):
    import html

    from churnframe.llm.queries import QUERIES
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op1_html_template"](spark, SF).collect():
        body = re.split(r"</article>", pages[r.page_id].partition("<article>")[2])[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_html_without_article_uses_the_densest_slot(spark):
    from churnframe.llm.html_template import extract
    page = ('<html><body><div class="top"><ul><li><a href=a>Home {0}</a><li><a href=b>About us</a></ul></div>'
            '<div class="x1"><div class="y"><p>Long body text number {0} with many words.</p><p>More {0}.</p></div></div>'
            '<div class="cookie-notice">We use cookies</div><div class="z"><a href=c>Next {0}</a></div>'
            '<section id="comments"><p>A reader says {0}</p></section></body></html>')
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(8)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.main_text for r in out.collect()} == {
        i: f"Long body text number {i} with many words.\nMore {i}." for i in range(8)}


def test_pipeline_equals_plain_version(spark):
    """Quality rules and tokenisation by the tested operators, the stages
    between them by plain Python."""
    import corpus_pipeline
    from churnframe.llm.bpe import Codec, default_vocabulary
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}

    def shingles(words):
        return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
    first, lines = {}, []
    for d in sorted(kept):
        for i, line in enumerate(kept[d].split("\n")):
            s = shingles(line.lower().split())
            if s and s not in first:
                first[s] = (d, i)
            lines.append((d, i, line, s))
    order = sorted(first, key=first.get)
    holders, similar = {}, set()
    for s in order:
        shared = Counter(o for t in s for o in holders.get(t, ()))
        if any(n * 180 >= 80 * (len(s) + len(o)) for o, n in shared.items()):
            similar.add(s)
        for t in s:
            holders.setdefault(t, []).append(s)
    texts = {}
    for d, i, line, s in lines:
        if not s or (first[s] == (d, i) and s not in similar):
            texts.setdefault(d, []).append(line)
    texts = {d: "\n".join(x) for d, x in texts.items()}
    texts = {d: t for d, t in texts.items() if t.split()}
    comp = _components({d: shingles(t.lower().split()) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if comp[d] == d}
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d: t for d, t in texts.items() if not any(
        w[i:i + len(item)] == item for w in [t.lower().split()] for item in items for i in range(len(w)))}
    with open(default_vocabulary(), encoding="utf-8") as f:
        codec = Codec(f.read())
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {d: len(codec.encode(t)) for d, t in clean.items()}


def test_line_dedup_of_near_copies(spark, rng):
    from churnframe.llm.line_dedup import line_verdicts
    base = [_text(rng, n).split() for n in (60, 45, 30, 12, 5, 3)]
    docs = {}
    for d in range(80):
        lines = []
        for b in base:
            w = list(b)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            lines.append(" ".join(w) if rng.random() < 0.8 else _text(rng, rng.randrange(1, 30)))
        rng.shuffle(lines)
        docs[d] = "\n".join(lines + [""])
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {(r.doc, r.line): r.removed for r in line_verdicts(df).collect()}
    earlier, want = [], {}
    for d in sorted(docs):
        for i, line in enumerate(docs[d].split("\n")):
            w = line.lower().split()
            s = set(w)
            want[d, i] = bool(s) and any(180 * len(s & o) >= 80 * (len(s) + len(o)) for o in earlier)
            if s:
                earlier.append(s)
    assert got == want and 50 < sum(want.values()) < len(want) - 50
