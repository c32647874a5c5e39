"""Url templates and HTML extraction."""

import html as entities
import re
import time

from pyspark.sql import functions as F

from brightloom.llm import html_extract, url_templates
from brightloom.llm.queries import URL_RULES
from brightloom.plans.common import table

SF = "/root/testdata/sf0.01"


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((str(r) for r in fits), key=len, default=None)


ODD = [None, "", "no scheme", "http://", "http://A.Com", "http://a.com/", "x://www.EXAMPLE.com/en/1?q=/", "ftp://example.com/en", "http://b.example.com/en/#/x", "a://b://c.com/", "http://é.NET/es/ü", "http://q.net?x/es/"]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "l") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, label string")


def test_hosts_paths_and_rules(spark):
    urls = [r["url"] for r in table(spark, SF, "pages").select("url").collect()] + ODD + ODD
    got = url_templates.judge_urls(pages(spark, urls), URL_RULES).collect()
    assert len(got) == len(urls)
    action = {str(r): r.action for r in URL_RULES}
    for r in got:
        assert (r["host"], r["path"], r["rule"]) == brute_rule(urls[r["page_id"]])
        assert r["verdict"] == action[r["rule"]] if r["rule"] else r["verdict"] in ("allow", "block")
    assert url_templates.judge_urls(pages(spark, urls).limit(0), URL_RULES).count() == 0


def test_templates_generalise_and_merge(spark):
    urls, labels = [], []
    for i in range(200):
        for section, bad in (("news", 0), ("blog", 0), ("spam", 1)):
            urls.append(f"http://h.org/{section}/{i}/title-{i}")
            labels.append(bad if i % 2 else None)
        urls.append(f"http://h.org/user{i}/about")
        labels.append(None)
    rows = spark.createDataFrame([("h.org", u.split("h.org")[1], x) for u, x in zip(urls, labels)], "host string, path string, label int")
    out = url_templates.path_templates(rows)
    count = {r["template"]: r["count"] for r in out.groupBy("template").count().collect()}
    assert count == {"/(blog|news)/*/*": 400, "/spam/*/*": 200, "/*/about": 200}
    purity = {r["template"]: r["purity"] for r in url_templates.template_purity(out).collect()}
    assert purity["/spam/*/*"] > 0.9 and purity["/(blog|news)/*/*"] < 0.05 and 0.2 < purity["/*/about"] < 0.5


def test_small_equal_sections_keep_their_own_labels(spark):
    names = [f"{a}{b}" for a in "abcde" for b in "vwxyz"]  # 25 sections of 4 %
    rules = [url_templates.Rule("block", "x.net", "/av/"), url_templates.Rule("block", "x.net", "/bw/"), url_templates.Rule("block", "x.net", "/ez/old/"), url_templates.Rule("allow", "com", "/")]
    urls = [f"http://x.net/{s}/{i}" for s in names for i in range(400)]
    urls += [f"http://y.com/{i}" for i in range(2000)]  # of these and the blocked ones comes the rate of all urls
    urls += [f"http://x.net/ez/old/{i}" for i in range(60)] + [f"http://x.net/ez/new/{i}" for i in range(60)]
    got = url_templates.judge_urls(pages(spark, urls), rules).collect()
    verdicts = {}
    got = [r for r in got if r["host"] == "x.net"]
    for r in got:
        verdicts.setdefault(r["path"].split("/")[1], set()).add((r["verdict"], r["rule"] is not None))
    assert verdicts == {s: {("block", True)} if s in ("av", "bw") else {("allow", False)} if s != "ez" else verdicts["ez"] for s in names}
    section = lambda r: r["template"].split("/")[1]
    assert not {section(r) for r in got if r["rule"]} & {section(r) for r in got if r["path"].split("/")[1] not in ("av", "bw", "ez")}
    assert {r["verdict"] for r in got if "/new/" in r["path"]} == {"allow"}


def test_any_number_of_sections_and_no_chance_literals(spark):
    few = [(f"/{s}{i:03d}/{1000 * i + j}", int(s == "bad") if j % 2 else None) for i in range(150) for s in ("bad", "good") for j in range(20)]
    few += [(f"/{i}/{1000 * i + j}", None) for i in range(300) for j in range(6)]
    rows = spark.createDataFrame([("h", p, x) for p, x in few], "host string, path string, label int")
    templates = {}
    for r in url_templates.path_templates(rows).collect():
        templates.setdefault(r["path"].split("/")[1].rstrip("0123456789") or "id", set()).add(r["template"])
    assert len(templates["bad"]) == 1 and len(templates["good"]) == 1 and not templates["bad"] & templates["good"]
    assert templates["id"] == {"/*/*"}


def test_deep_paths_are_summed_up(spark):
    rows = spark.createDataFrame([("h", "/a" * 30, None), ("h", "", None), ("h", "///", None)], "host string, path string, label int")
    got = {r["path"]: r["template"] for r in url_templates.path_templates(rows, min_support=1, max_depth=3).collect()}
    assert got == {"/a" * 30: "/a/a/a/**", "": "", "///": ""}


def test_the_tree_goes_as_deep_as_its_paths(spark):
    rows = [("h", "/s" * 13 + f"/{'bad' if i % 2 else 'good'}/{i}", i % 2) for i in range(60)] + [("one", "/x" * 70, None), ("two", "/y" * 9, None)] * 2 + [("h", "/s", None)]
    got = {}
    for r in url_templates.path_templates(spark.createDataFrame(rows, "host string, path string, label int")).collect():
        got.setdefault(r["template"], []).append(r["path"])
    assert {t: len(p) for t, p in got.items()} == {"/s" * 13 + "/bad/*": 30, "/s" * 13 + "/good/*": 30, "/*" * 70: 2, "/*" * 9: 2, "/s": 1}


def test_articles_are_extracted_whole(spark):
    rows = table(spark, SF, "pages").collect()
    got = {r["page_id"]: r for r in html_extract.extract_pages(table(spark, SF, "pages")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        text = re.sub(r"<(/?)(b|p|br|h1)>", lambda m: "" if m[2] == "b" else " ", inner)
        want = " ".join(entities.unescape(text).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


LONG = "This is the text of the article, and it is one that has all of the words that are in a text of this kind, so that it is long and the rules can see what it is for."
PAGE = f"""<html><head><title>t</title><script>if (a<b) x("</p>")</script><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site of the day</h1></header><nav><a href="/">Home</a></nav><div class="cookie-banner"><p>{LONG}</p></div>
<form action="x"><p>Sign up for the letter</p></form><div id="content"><article><h1>Title &amp; more</h1><p>{LONG}
<b>Bo</b>ld<br>line<p>Short.<ul><li>one<li>two</ul><div class="ad">Buy <b>now</b></div><table><tr><td>1<td>2</table>
<section class="reader-comments"><p>{LONG}</p></section></article></div><aside><p>{LONG}</p></aside><footer>&copy; me</footer></body></html>"""


def test_declared_boilerplate_is_left_out():
    assert html_extract.main_text(PAGE) == f"Title & more {LONG} Bold line Short. one two 1 2"


def test_rules_find_the_article_without_article_elements(spark):
    """The same pages with plain containers: text, not markup, tells the article."""
    for r in table(spark, SF, "pages").collect():
        plain = r["html"].replace("<article", "<div").replace("</article", "</div")
        assert html_extract.main_text(plain) == html_extract.main_text(r["html"])
    plain = PAGE.replace("<article>", "<div class='story'>").replace("</article>", "</div>")
    assert html_extract.main_text(plain) == html_extract.main_text(PAGE)


def test_hints_never_empty_a_page():
    for name in ("share-holders", "search", "respond", "promo", "alert", "notice", "banner", "comments", "sidebar"):
        assert html_extract.main_text(f"<body><div class='{name}'><h1>T</h1><p>{LONG}</p><p>Short</p></div></body>") == f"T {LONG} Short"
    assert html_extract.main_text(f"<body><form><table><tr><td><p>{LONG}</p></td></tr></table></form></body>") == LONG
    # a hint counts where there is other text, a compound name with another meaning is none
    page = f"<body><div><p>{LONG}</p><div class='notice-board'><p>Pinned here</p></div><p>{LONG}</p><div class='ad-box'><p>{LONG}</p></div></div><footer>c</footer>"
    assert html_extract.main_text(page) == f"{LONG} Pinned here {LONG}"


def test_links_around_blocks_are_links():
    teasers = "".join(f"<a href=x><div><h3>Teaser {i} of the many that are in this place and more</h3><p>{LONG}</p></div></a>" for i in range(3))
    assert html_extract.main_text(f"<body><div id=m><p>{LONG} {LONG}</p></div><div class=list>{teasers}</div>") == f"{LONG} {LONG}"


def test_short_blocks_at_the_end_of_a_page():
    page = f"<body><div class=content><h1>Head</h1><p>{LONG}</p><p>ok</p><div class=x>inner short</div></div><div class=foot>&copy; 2024 Co</div></body>"
    assert html_extract.main_text(page) == f"Head {LONG} ok inner short"


def test_long_pages_take_time_in_proportion():
    for piece in ("<a ", '<a "', "<!", "<textarea>", "<div>", "<span class=ad>", "<article>", "</p>", "<b><i></b>", '<x1 y="<', "<nav><article>", "<a href=x>"):
        start = time.process_time()
        html_extract.main_text(piece * (1_000_000 // len(piece)))
        assert time.process_time() - start < 5, piece


def test_pages_without_article_elements():
    links = "".join(f'<li><a href="{i}">Section number {i} of this site</a></li>' for i in range(9))
    page = f"<body><ul>{links}</ul><div><h2>A title</h2><p>{LONG} {LONG}</p><p>Yes.</p><p>{LONG} {LONG}</p></div><div><p>login | register</p><ul>{links}</ul></div>"
    assert html_extract.main_text(page) == f"A title {LONG} {LONG} Yes. {LONG} {LONG} login | register"


def test_odd_pages(spark):
    cases = [None, "", " ", "<", "<p", "plain &lt;text&gt;", "<nav>x<article>Body</article>", "<p>a" * 50000, "<div><article>x", "<!-- a", "<script>x", "&#x41;&nbsp;&bogus; b"]
    want = ["", "", "", "<", "<p", "plain <text>", "Body", " ".join("a" * 50000), "x", "", "", "A &bogus; b"]
    df = spark.createDataFrame([(i, None, h, "t", 1) for i, h in enumerate(cases + cases)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(html_extract.extract_pages(df).collect(), key=lambda r: r["page_id"])
    assert [r["text"] for r in got] == want + want
    assert html_extract.extract_pages(df.filter(F.lit(False))).count() == 0
