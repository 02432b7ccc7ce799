import math

from pyspark.sql import functions as F

from corpusloom.llm.pagebody import LEAST, importances, main_lines, site_nodes

FRAME = ["Home / About / Contact", "We use cookies on Acme.", "Accept all", "© 2024 Acme. All rights reserved.", "Back to top"]


def page(i, site="www.acme.example", whole=False, headline=True):
    title = f"Why number {i} differs from the rest"
    body = [f"Paragraph {i} of a text about subject {i * 7} that says something of its own.", "Steps", f"- item{'abcdefghij'[i % 10]}"] if i % 4 == 0 else [f"Another paragraph about thing{chr(97 + i % 26)} {i}, it has its own words."]
    lines = [*FRAME[:3], "Recent posts", f"How to merge the {chr(97 + i % 26)}{chr(97 + i // 26)} thing", f"Working with part {i}", *([title] if headline else []), *body, "", *FRAME[3:], f"#{i}"]
    own = {title, *body}
    doc = f"https://{site}/a/why-number-{i}-differs-from-the-rest-{i}" if headline else f"page_{i}"
    elements = [("\n".join(lines), own)] if whole else [(x, own) for x in lines]
    return [(i * 100 + k, doc, site, 1000.0 + k, "text", c, o) for k, (c, o) in enumerate(elements)]


def run(spark, rows, urls=()):
    df = spark.createDataFrame([(*r[:6], 1) for r in rows], "elem_id long, doc_id string, site string, position double, element_type string, content string, line_no int")
    links = spark.createDataFrame(list(urls), "doc_id string, url string")
    return {(r.elem_id, r.line_no) for r in main_lines(df, links).collect()}


def want(rows):
    return {(r[0], n) for r in rows for n, line in enumerate((r[5] or "").split("\n")) if line.strip() and line in r[6]}


def test_pages_of_a_site(spark):
    rows = [r for i in range(1, 41) for r in page(i, whole=i % 5 == 0)]
    assert run(spark, rows) == want(rows)


def test_a_small_site_leans_on_the_others(spark):
    rows = [r for k in range(12) for i in range(1, 9) for r in [(x[0] + k * 100_000, *x[1:5], (x[5] or "").replace("Acme", f"Site{k}q"), {y.replace("Acme", f"Site{k}q") for y in x[6]}) for x in page(i, f"www.site{k}q.example")]]
    rows += [(x[0] + 9_000_000, *x[1:5], x[5].replace("Acme", "Lonely").replace("How to merge", "Ways of joining"), x[6]) for x in page(3, "www.lonely.example")]
    assert {x for x in run(spark, rows) if x[0] > 9_000_000} == {x for x in want(rows) if x[0] > 9_000_000}


def test_odd_tables(spark):
    rows = [r for i in range(1, 31) for r in page(i)]
    twice = [(r[0] + 50_000, *r[1:]) for r in rows if r[1].endswith("-7")]
    odd = [(90_001, None, "www.acme.example", 1.0, "text", "A stray sentence without a page, kept as it is.", {"A stray sentence without a page, kept as it is."}), (90_002, "x", None, None, "text", "  \n\n", set()), (90_003, "x", None, None, None, None, set()), (90_004, "y", None, 1.0, "image", "A caption of a picture", {"A caption of a picture"}), (90_005, "z", "s", 1.0, "text", "word " * 100_000 + "\n" + "x", {"word " * 100_000})]
    got = run(spark, rows + twice + odd, [("y", None), (None, "u"), ("y", "https://a.b/c")])
    assert got >= want(rows + twice) and (90_001, 0) in got and (90_004, 0) in got and (90_005, 0) in got
    assert not any(e in (90_002, 90_003) for e, _ in got)
    assert run(spark, rows[:0]) == set()


def node_row(m, n, total=None, spread=0.0, entries=0, prose=0, others=0):
    return (m, n, total or n, spread, entries, prose, others)


def composite(spark, *rows):
    df = spark.createDataFrame(list(rows), "m long, n long, total long, spread double, entries long, prose long, others long").coalesce(1)
    df = df.withColumns({c: F.lit(0.0) for c in ("share", "share_entries", "share_prose", "share_others")})
    return [(r.composite, r.entry) for r in importances(df).collect()]


def test_importance_hangs_on_size_distribution_and_styles(spark):
    few, many, uneven, always, mixed = composite(
        spark,
        node_row(20, 10),
        node_row(20_000, 10_000),
        # as many pages and places, but nearly all places on one page: less entropy
        node_row(20_000, 10_000, 100_000, 90_001 * math.log(90_001)),
        node_row(400, 200, entries=200),
        node_row(400, 200, entries=100, prose=60, others=40),
    )
    assert few[0] > many[0] and uneven[0] > many[0]
    assert mixed[0] > always[0] and always[1] < LEAST < mixed[1] + 0.1


def test_sites_of_equal_shares_and_unequal_entropy(spark):
    """One line on every page of both sites: pruned where it is spread evenly, kept where nearly all its places are on one page."""
    even = [(i, f"e{i}", "even.example", 1.0, "text", f"word{i}x of its own here.\n" + "A line that comes again.\n" * 30, set()) for i in range(60)]
    skew = [(1000 + i, f"s{i}", "skew.example", 1.0, "text", f"word{i}x of its own here.\n" + "A row that comes again.\n" * (200_000 if i == 0 else 1), set()) for i in range(60)]
    got = run(spark, even + skew)
    assert {e for e, n in got if n == 1 and e < 1000} == set() and {e for e, n in got if n == 1 and e >= 1000} == set(range(1000, 1060))


def test_planted_body_is_found(spark):
    """Recall and precision over sites whose frame and body are known."""
    rows = [r for k in range(6) for i in range(1, 61) for r in [(x[0] + k * 100_000, *x[1:5], x[5].replace("Acme", f"Site{k}q"), {y.replace("Acme", f"Site{k}q") for y in x[6]}) for x in page(i, f"www.site{k}q.example", whole=i % 3 == 0, headline=i % 4 > 0)]]
    got, true = run(spark, rows), want(rows)
    assert len(got & true) >= 0.95 * len(true) and len(got & true) >= 0.95 * len(got)
