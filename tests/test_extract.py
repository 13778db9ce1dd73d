"""HTML extraction (X1-X5) on the FIXTURES page, including hidden spans."""

from filingflow.operators import extract

PAGE = """<div id="code"><span class="k">0100</span></div>
<table class="h"><tr><th scope="col">Item</th><th scope="col">Code</th></tr></table>
<div class="t"><div class="r"><span>Cash<span style="display:none">x</span></span><span>110</span></div>
<div class="r"><span>Debt</span><span></span></div></div>"""
CFG = {"header": '.h th[scope="col"]', "table": None, "row": ".t .r", "cell": "span"}
QUIRK = '<div class="t"><div class="r"><span style="display:none">x</span><span><span>7</span></span></div></div>'


def pages(spark, html):
    return spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")


def test_spans_mode(spark):
    ex = extract.extract_cells(pages(spark, PAGE), CFG, "spans")
    rows = extract.table_rows(ex, "spans").orderBy("row_no").collect()
    assert rows[0]["headers"] == ["Item", "Code"]
    assert [r["row"] for r in rows] == [["Cash", "110"], ["Debt", ""]]


def test_hidden_span_quirk(spark):
    cfg = {"header": None, "row": ".t .r", "cell": "span"}
    plain = extract.extract_cells(pages(spark, QUIRK), cfg, "spans").first()["rows"]
    faithful = extract.extract_cells(pages(spark, QUIRK), cfg, "spans", faithful=True).first()["rows"]
    assert plain == [["7"]]
    assert faithful == [["x", "7", "7"]]


def test_flat_and_rendered(spark):
    cfg = {"header": '.h th[scope="col"]', "row": ".t .r span"}
    ex = extract.extract_cells(pages(spark, PAGE), cfg, "flat").first()
    assert ex["headers"] == ["Item", "Code"]
    rows = extract.table_rows(extract.extract_cells(pages(spark, PAGE), cfg, "flat"), "flat").collect()
    assert [r["row"] for r in rows] == [["Cash", ""], ["110", "Debt"], ["", None]]
    cfg = {"header": '.h th[scope="col"]', "row": ".t .r", "cell": "span"}
    rr = extract.table_rows(extract.extract_cells(pages(spark, PAGE), cfg, "rendered"), "rendered").collect()
    assert rr[0]["headers"] == ["Code"]
    assert [r["row"] for r in rr] == [["Cash", "", "110"], ["Debt", ""]]


def test_firm_info(spark):
    f = extract.firm_info(pages(spark, PAGE), {"code": "#code .k", "name": ".h th", "title": None}).first()
    assert (f["code"], f["name"], f["title"]) == ("0100", "Item", None)


def test_unclosed_paragraphs(spark):
    html = "<article><h1>T</h1><p><b>Head<br><p>One</p><p>Two <b>B</b></p></article>"
    cfg = {"table": "article", "header": "h1", "row": "p", "cell": "b"}
    rows = extract.extract_cells(pages(spark, html), cfg, "spans").first()["rows"]
    assert rows == [["Head"], [], ["B"]]


def test_header_scope_first_container(spark):
    html = ('<table class="h"><tr><th scope="col">A</th></tr></table>'
            '<table class="h"><tr><th scope="col">B</th></tr></table>'
            '<div class="t"><div class="r"><span>1</span></div></div>')
    cfg = {"header_scope": ".h", "header": 'th[scope="col"]', "table": ".t", "row": ".r"}
    ex = extract.extract_cells(pages(spark, html), cfg, "spans").first()
    assert ex["headers"] == ["A"] and ex["rows"] == [["1"]]
    cfg = {"header": '.h th[scope="col"]', "row": ".t .r span"}
    assert extract.extract_cells(pages(spark, html), cfg, "flat").first()["headers"] == ["A", "B"]


def test_ids_of_any_type_and_null_pages(spark):
    rows = [(None, "u", PAGE), ("a", "u", None), ("a", "u", PAGE), ("b", "u", "")]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {(r["page_id"], len(r["rows"])) for r in extract.extract_cells(df, CFG, "spans").collect()}
    assert got == {(None, 2), ("a", 0), ("a", 2), ("b", 0)}
    assert extract.firm_info(spark.createDataFrame([(None, "u", PAGE)], "page_id long, url string, html string"), {"code": "#code .k"}).first()["code"] == "0100"


def test_deep_and_unclosed_markup(spark):
    deep = "<div>" * 20_000 + '<div class="r"><span>x<span style="display:none">h</span></span></div>'
    cells = "".join(f"<tr class=r><td><span>{i}</span><td><span>{i * i}</span>" for i in range(3_000))
    for html, expect in ((deep, [["x"]]), (f"<table>{cells}", [[str(i), str(i * i)] for i in range(3_000)])):
        assert extract.extract_cells(pages(spark, html), {"row": ".r", "cell": "span"}, "spans").first()["rows"] == expect
    assert extract.extract_cells(pages(spark, "</p></b>" * 50_000 + "<p>a"), {"row": "p"}, "flat").first()["cells"] == ["a"]


def test_spans_as_the_reference_lists_them(spark):
    """Every span of a row is a cell; a hidden one goes when it is inside a span, with what it holds."""
    row = (
        '<span>a<span style="display:none">b<span>c</span></span>d</span><span style="display:none">e</span>'
        '<i><span style="display: none">f</span></i><span> g <b> h </b><span>i</span></span><span><br></span>'
    )
    html = f'<div class="r">{row}</div>'
    listed = extract.extract_cells(pages(spark, html), {"row": ".r", "cell": "span"}, "spans", faithful=True).first()["rows"]
    assert listed == [["ad", "e", "f", "ghi", "i"]]
    visible = extract.extract_cells(pages(spark, html), {"row": ".r", "cell": "span"}, "spans").first()["rows"]
    assert visible == [["ad", "ghi"]]


def test_ranges_hold_what_is_inside():
    page = extract.Page('<div id=a><p>1<p>2<b>3</b><ul><li>4<li>5</ul></div><p class="x y">6<script>7</script>')
    assert [page.tags[e] for e in page.select("div p, div b, .x.y, #a li")] == ["p", "p", "b", "li", "li", "p"]
    assert [page.whole_text(e) for e in page.select("p")] == ["1", "23", "6"]
    assert [page.whole_text(e) for e in page.select("li", page.select("ul")[0])] == ["4", "5"]
    assert page.select("[id]") == page.select("[id=a]") == [0] and page.select("p p") == []
