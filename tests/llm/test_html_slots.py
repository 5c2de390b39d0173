"""Template deduction on pages whose names say nothing."""


def _texts(spark, pages, host="h.example"):
    from churnframe.llm.html_template import extract
    rows = [(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r.main_text for r in out.orderBy("page_id").collect()]


def test_constant_text_in_neutral_elements_is_template(spark):
    page = ('<html><body><div class="q1"><div class="k1"><p>We keep the usual files on the machine of the reader.</p></div>'
            '<p>Alpha{0} beta{0} gamma{0} is the text of number {0}.</p><p>More{0} words{0} here{0}.</p>'
            '<div class="k2"><p>Buy one and get one for <b>nothing</b> today.</p></div></div></body></html>')
    assert _texts(spark, [page.format(i) for i in range(6)]) == [
        f"Alpha{i} beta{i} gamma{i} is the text of number {i}.\nMore{i} words{i} here{i}." for i in range(6)]
    inside = "<html><body><article>" + page[12:].replace("</body></html>", "</article></body></html>")
    assert _texts(spark, [inside.format(i) for i in range(6)]) == [
        f"Alpha{i} beta{i} gamma{i} is the text of number {i}.\nMore{i} words{i} here{i}." for i in range(6)]


def test_equal_pages_of_a_host_do_not_make_their_text_template(spark):
    page = "<html><body><article><p>One text that was stored again.</p></article></body></html>"
    assert _texts(spark, [page] * 6) == ["One text that was stored again."] * 6


def test_words_that_change_place_are_no_template(spark):
    a, b = "<div class=a>x{0}</div>", "<div class=b>y{0}</div>"
    page = "<html><body><article><p>t{0}</p>%s</article></body></html>"
    pages = [(page % (a + "Sometimes here" + b if i % 2 else a + b + "Sometimes here")).format(i) for i in range(6)]
    got = _texts(spark, pages)
    assert all("Sometimes here" in t for t in got)
    pages = [(page % (a + "Always here" + b)).format(i) for i in range(6)]
    assert _texts(spark, pages) == [f"t{i}\nx{i}\ny{i}" for i in range(6)]


def test_elements_out_of_order_or_nesting_leave_their_class():
    import json

    from churnframe.llm.html_template import Template

    def token(cls, path, at, pages):
        return {"class": cls, "path": path, "word": "", "label": "-", "pages": pages, "at": at}
    t = Template(json.dumps([token("r", "/r", 0, 9), token("r", "/r/a", 1, 9), token("r", "/r/b", 2, 9),
                             token("s", "/r/x", 1, 4), token("s", "/r/y", 3, 4)]))

    def cut(page):
        return {p for p, w, *_ in t.check(page) if w == ""}
    assert cut("<r><a></a><b></b></r>") == set()
    assert cut("<r><b></b><a></a></r>") == {"/r/b"}
    assert cut("<r><a></a><x></x><y></y><b></b></r>") == set()
    assert cut("<r><a></a><x></x><b></b><y></y></r>") == {"/r/y"}


def test_content_names_inside_boilerplate_do_not_hide_the_body(spark):
    page = ('<html><body><aside><ul><li class="post">Old entry {0}</li></ul></aside><div class="q1"><div class="q2">'
            '<p>The body of page {0} lies in plain elements.</p><p>It has {0} more.</p></div></div>'
            '<footer><div class="story">Told {0}</div></footer></body></html>')
    want = [f"The body of page {i} lies in plain elements.\nIt has {i} more." for i in range(6)]
    assert _texts(spark, [page.format(i) for i in range(6)]) == want
    assert _texts(spark, [page.format(0)]) == want[:1]
    # a page without the slot of the others
    other = "<html><body><nav><p class=post>Go</p></nav><h2>Alone {0}</h2></body></html>"
    assert _texts(spark, [page.format(i) for i in range(6)] + [other.format(7)]) == want + ["Alone 7"]


def test_hosts_with_equal_paths_keep_their_own_slots(spark):
    from churnframe.llm.html_template import extract
    page = ('<html><body><div class="u"><p>%s</p></div><div class="v"><p>%s</p></div></body></html>')
    long, short = "This is the long text of page {0} with many words in it.", "Short {0}."
    rows = [(2 * i, f"http://one.example/{i}", (page % (long, short)).format(i)) for i in range(5)]
    rows += [(2 * i + 1, f"http://two.example/{i}", (page % (short, long)).format(i)) for i in range(5)]
    out = extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    assert {r.page_id: r.main_text for r in out.collect()} == {i: long.format(i // 2) for i in range(10)}
