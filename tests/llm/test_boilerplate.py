from sieveworks.llm import boilerplate as B

BODY = "You will sort seed orders with the data group number {0} and repair the test rigs of team {0} in the north."


def page(i, cls="x1"):
    return f"""<!doctype html>
<html><body>
<script>var a = "<p>not shown</p>";</script>
<div class="{cls}">
<div>Skip to main content</div>
<a href="#">News</a>
</div>
<div class="x8">
<h1>Clerk {i}</h1>
<p>{BODY.format(i)}</p>
<div class="pay-sidebar"><p>Travel to site {"abcdefghij"[i % 10]} is rare for this team.</p></div>
<div class="x7"><a href="#">Similar jobs</a>
<a href="#">Buyer {"abcdefghij"[i % 10]}, Oslo</a></div>
</div>
<small>© 2024 Acme</small>
</body></html>"""


def test_pages(spark):
    rows = [(i, "https://h.example/jobs", page(i), f"Skip to main content\nNews\n{BODY.format(i)}\nSimilar jobs\nBuyer q, Oslo\n\n© 2024 Acme") for i in range(12)]
    rows += [(20, "https://h.example/jobs", None, f"Skip to main content\n{BODY.format(7)}"), (21, "https://h.example/jobs", "<p>only a fragment</p>", None), (22, None, "", ""), (23, "https://h.example/jobs", "<html><body><h1>Loading</h1></body></html>", "Loading")]
    df = spark.createDataFrame(rows, "row_id long, portal_url string, description_html string, description string")
    got = {}
    for r in B.find_furniture(df, "row_id", "description_html", "description", "portal_url").collect():
        got.setdefault((r.row_id, r.field), set()).add(r.line_no)
    lines = page(0).split("\n")
    html = {n for n, x in enumerate(lines, 1) if any(w in x for w in ("Skip to", "News", "Similar", "Buyer", "© 2024"))}
    for i in range(12):
        assert got[i, "description_html"] == html
        assert got[i, "description"] == {1, 2, 4, 5, 7}
    assert got[20, "description"] == {1} and not {21, 22, 23} & {k[0] for k in got}


def test_empty(spark):
    df = spark.createDataFrame([], "row_id long, portal_url string, description_html string, description string")
    assert B.find_furniture(df, "row_id", "description_html", "description", "portal_url").collect() == []


def test_one_line_page_has_no_mixed_case():
    parts = B.pieces("<html><body><nav><a href=x>News</a></nav><main><p>Text of the body.</p></main></body></html>")
    assert [p[0] for p in parts] == [1, 1] and parts[0][3] and not parts[1][3]


def test_small_hosts_keep_their_own_wording(spark):
    """A line on 5 of 30,000 pages is furniture for its own host, whichever way the lists travel, and for no other."""
    row = "row_id long, portal_url string, description_html string, description string"
    other = "<!doctype html><html><body><div class='m'><p>You will sort the seed orders of the crew and repair the test rigs.</p></div></body></html>"
    big = spark.range(1000, 31000).selectExpr("id AS row_id", "'https://big.example/' AS portal_url", f'"{other}" AS description_html', "CAST(NULL AS STRING) AS description")
    small = page(0).replace("News", "Harbour gazette")
    rows = [(i, "https://small.example/", small, None) for i in range(5)] + [(10, "https://small.example/", None, "Harbour gazette\nText"), (11, "https://big.example/", None, "Harbour gazette\nText")]
    df = big.union(spark.createDataFrame(rows, row))
    for most in ((), (0,)):
        got = B.find_furniture(df, "row_id", "description_html", "description", "portal_url", *most)
        assert [(r.row_id, r.line_no) for r in got.filter("field = 'description'").collect()] == [(10, 1)]


def test_many_hosts_of_few_pages(spark):
    """1,000 hosts of 20 pages, each with wording of its own, long notices included: recall of planted lines in both fields."""
    names = ["abcdefghij"[i % 10] + "klmnopqrst"[i // 10 % 10] + "uvwxyzabcd"[i // 100] for i in range(1000)]
    rows, want, n = [], set(), 0
    for h, w in enumerate(names):
        notice = f"The {w} pages keep small files so that the {w} search works, and so that visits of the {w} site can be counted by the {w} crew every week of the year."
        for j in range(20):
            own = "abcdefghijklmnopqrst"[j]
            body = f"You will sort the seed orders of the {w} crew {own} and repair their test rigs with the data group each week. In this post of the {own} series you plan and label loading bays with the night crew before each audit of the season."
            lines = [f"{w} gazette", notice, f"Home > {w} > Clerk {own}", body, f"© 2024 {w}"]
            page = "<!doctype html>\n<html><body>\n" + f"<nav><a href=#>{w} gazette</a></nav>\n<div class='c'>{notice}</div>\n<ul class='t'><li>Home > {w} > Clerk {own}</li></ul>\n<div class='m'><p>{body}</p></div>\n<small>© 2024 {w}</small></body></html>"
            html, text = (page, None) if j % 2 else (None, "\n".join(lines))
            rows.append((n, f"https://{w}.example/jobs", html, text))
            want |= {(n, "description_html", x) for x in (3, 4, 5)} if j % 2 else {(n, "description", x) for x in (1, 2, 3)}
            n += 1
    df = spark.createDataFrame(rows, "row_id long, portal_url string, description_html string, description string")
    got = {(r.row_id, r.field, r.line_no) for r in B.find_furniture(df, "row_id", "description_html", "description", "portal_url").collect()}
    for f in ("description_html", "description"):
        mine = {x for x in want if x[1] == f}
        assert len(mine & got) >= 0.95 * len(mine)
    assert not {(i, f, no) for i, f, no in got if no == (6 if f == "description_html" else 4)}  # the body
