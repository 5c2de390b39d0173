"""Chat formatting, tokenizer alignment and collocations: plain versions,
SQL, nulls, empty and long texts, ties, repeats, clashing names."""

import random
from collections import Counter

import brute_align
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,tables", [("op11_phrase_collocations", ["documents"]), ("op13_chat_format", ["conversations"])])
def test_query_matches_sql(spark, name, tables):
    from churnframe.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*cols).collect()) == Counter(res.fetchall())


# --- chats


def test_any_text_and_role_is_read_back(spark):
    from churnframe.llm.chat_format import format_chats, joined, read_back
    rng = random.Random(3)
    parts = ["#", "##", "###", "\\", "</turn>", "<", "/turn>", "</turn>\n", " ", ": ", "### User: ", "é", "😀", "\n"]
    roles = ["user", "assistant", "system", None, "x: y", "Role z", "User", "a</turn>\n", "#### "]
    rows = [(i, t, rng.choice(roles), "".join(rng.choice(parts) for _ in range(rng.randrange(9))))
            for i in range(200) for t in range(rng.randrange(1, 5))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: [(x.role, x.text) for x in r.t] for r in format_chats(df).select(
        "conv_id", read_back(joined(F.col("segments"))).alias("t")).collect()}
    want = {}
    for i, _, r, x in rows:
        want.setdefault(i, []).append((r or "", x))
    assert back == want


def test_machine_and_loss_segments(spark):
    from churnframe.llm.chat_format import format_chats, segment_rows
    chats = {1: "user assistant", 2: "system user assistant user assistant", 3: "assistant", 4: "user user",
             5: "user assistant user", 6: "user system assistant", 7: "user robot assistant"}
    rows = [(i, t, r, f"t{t}") for i, s in chats.items() for t, r in enumerate(s.split())]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_chats(df)
    assert {r.conv_id: (r.valid, r.bad_turn) for r in out.collect()} == {
        1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (False, 3), 6: (False, 1), 7: (False, 1)}
    seg = [(r.text, r.loss) for r in segment_rows(out).filter("conv_id = 1").orderBy("at").collect()]
    assert seg == [("### User: ", False), ("t0", False), ("</turn>\n", False),
                   ("### Assistant: ", False), ("t1", True), ("</turn>\n", False)]


def test_chat_edges(spark):
    from churnframe.llm.chat_format import digest, format_chats
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "", 1), (2, None, "user", "x" * 300_000, 1), (2, 0, None, "#" * 9, 1),
            (None, 0, "user", "a", 1), (None, 0, "user", "a", 1), (3, 0, "user", "b", 1), (3, 0, "assistant", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    got = {r.conv_id: r for r in digest(format_chats(df)).collect()}
    assert {k: v.n_turns for k, v in got.items()} == {1: 2, 2: 2, None: 2, 3: 2}
    assert got[1].valid and got[1].loss_chars == 0 and got[2].formatted_chars == 300_000 + 10 + 8 + 11 + 9 + 7 + 8
    assert not got[3].valid  # a tie in the turn goes by role
    assert digest(format_chats(df.limit(0))).count() == 0


def test_own_template(spark):
    from churnframe.llm.chat_format import Template, format_chats, joined, loss_text, read_back
    t = Template(mark="<|", colon="|>", footer="<|end|>", names={"q": "Q", "a": "A"}, trained=("a", "q"),
                 next_roles={"": ("q",), "q": ("a",), "a": ("q",)}, final=("a",))
    df = spark.createDataFrame([(1, 0, "q", "<|A|> <|end|>"), (1, 1, "a", "ok")], "conv_id long, turn long, role string, text string")
    r = format_chats(df, template=t).select("valid", joined(F.col("segments")).alias("f"), "segments").select(
        "valid", read_back(F.col("f"), t).alias("b"), loss_text(F.col("segments")).alias("l")).first()
    assert r.valid and [tuple(x) for x in r.b] == [("q", "<|A|> <|end|>"), ("a", "ok")] and r.l == "<|A|> <|end|>ok"


# --- alignment

FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def _texts():
    rng = random.Random(5)
    parts = ["a", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "漢字", "😀", "'s", "'ll", "1", "<|endoftext|>", "the",
             "ing", "abc" * 9, "▁", "　", " ", " ", "​", "<s>", "<0x41>", "\x00", "...", "word", "St", "ﬁ", "\r\n"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randrange(30))) for i in range(400)}
    texts |= {400: None, 401: "x" * 3000 + "漢" * 500, 402: " " * 700, 403: "ing ", 404: "ing ", 405: ""}
    return texts


@pytest.mark.parametrize("kw", [{}, {"slice_bytes": 2000, "broadcast_pairs": 50}, {"slice_bytes": 5000, "broadcast_pairs": 0}])
def test_alignment_equals_all_pairs_of_tokens(spark, kw):
    from churnframe.llm.align import align_tokenizers
    texts = _texts()
    df = spark.createDataFrame([(i, t, i, "z") for i, t in texts.items()],
                               "doc_id long, text string, N_best long, slice string").repartition(3)
    out = align_tokenizers(df, **kw)
    assert out.columns == ["doc_id", "slice", *FIGURES]  # the result replaces the column of its name
    want = brute_align.figures(texts)
    assert sum(w[0] == 0 for w in want.values()) > 10 < sum(w[0] > 0 for w in want.values())
    assert {r.doc_id: tuple(r[c] for c in FIGURES) for r in out.collect()} == want
    assert align_tokenizers(df.limit(0), **kw).count() == 0


def test_a_slice_is_encoded_in_parts_with_bounded_memory(monkeypatch):
    import tracemalloc

    from churnframe.llm import align
    a, b = align.default_vocabularies()
    with open(a, encoding="utf-8") as f, open(b, "rb") as g:
        pair = align.Pair(f.read(), g.read())
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(60_000)).encode()
    tracemalloc.start()
    align.encode_slice([text], pair)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 110 * len(text)  # 134 a byte with all stretches at once
    texts = [(t or "").encode() for t in _texts().values()]
    whole = align.encode_slice(texts, pair)
    monkeypatch.setattr(align, "ENCODED", 7)
    pair.known.clear()
    parts = align.encode_slice(texts, pair)
    assert whole["digests"] == parts["digests"]
    for k in ("codes", "links", "link_ix", "pairs", "counts", "stretches"):
        assert whole[k].tolist() == parts[k].tolist() and whole[k].dtype == parts[k].dtype


def test_gallop_finds_the_first_not_below():
    from churnframe.llm.align import gallop
    rng = np.random.default_rng(2)
    into = np.sort(rng.choice(5000, 900, replace=False))
    lo = rng.integers(0, 400, 300)
    hi = lo + rng.integers(1, 500, 300)
    wanted = np.array([rng.integers(0, into[h - 1] + 1) for h in hi])
    got = gallop(wanted, into, lo, hi)
    assert all(g == low + np.searchsorted(into[low:h], w) for g, low, h, w in zip(got, lo, hi, wanted))


def test_long_text_without_blanks(spark):
    from churnframe.llm.align import align_tokenizers
    df = spark.createDataFrame([(1, "abcdefgh" * 40_000)], "doc_id long, text string")
    r = align_tokenizers(df).first()
    assert r.n_a > 1000 and r.n_links >= max(r.n_a, r.n_b) and r.n_groups <= min(r.n_a, r.n_b)


# --- collocations


def _brute(rows, min_count, max_words=3):
    import re
    f, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] = f.get((lang, tuple(w[i:i + k])), 0) + 1
    cand = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= min_count}
    out = []
    for (lang, p), a in cand.items():
        inside = [n for (x, q), n in cand.items() if x == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * n >= 50 * a for n in inside):
            continue
        score, k, left, right = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, total[lang], score))
    ranked = {}
    for lang in {o[0] for o in out}:
        for i, o in enumerate(sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode())), 1):
            ranked[lang, i] = o[1:]
    return ranked


def _corpus(rng):
    vocab = ["Alpha", "b", "é", "g\xa0g", "x\x0by", "漢", "İ", "#", "w1", "w2"]
    seps = [" ", " ", " ", "\t ", ", ", ".", "\n", "  "]
    rows = []
    for i in range(300):
        t = "".join(rng.choice(vocab) + rng.choice(seps) for _ in range(rng.randrange(14)))
        rows.append((i, rng.choice(["en", "fr", None]), t, "y"))
    rows += [(300, "en", None, "y"), (301, "en", "", "y"), (302, "zz", "rare " * 3, "y"), (303, "en", "w1 w2 " * 4000, "y")]
    return rows + rows[:20]


@pytest.mark.parametrize("share", [0.0, 0.1, 1.0])
@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_collocations_equal_brute_force(spark, share, max_words):
    """Whatever the sample proposes (nothing, some, all), the result is whole."""
    from churnframe.llm.collocations import collocations
    rows = _corpus(random.Random(9))
    df = spark.createDataFrame(rows, "n long, lang string, text string, phrase string").repartition(3)
    out = collocations(df, min_count=6, max_words=max_words, share=share, slice_bytes=1500)
    got = {(r.lang, r.rank): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out.collect()}
    assert got == _brute([r[1:3] for r in rows], 6, max_words) and len(got) > 20


def test_collocations_of_nothing(spark):
    from churnframe.llm.collocations import collocations
    df = spark.createDataFrame([(1, "en", None)], "doc_id long, lang string, text string")
    assert collocations(df).count() == 0 and collocations(df.limit(0)).count() == 0
