import pytest

from tallyforge.llm.main_text import extract_main_text, main_text
from tallyforge.llm.queries import URL_RULES
from tallyforge.llm.url_rules import Automaton, Rule, judge_urls

LONG = "Words of the article go on for a while so that the ratio is high. " * 3


def page(inside, around=""):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav>{around}{inside}<footer>f</footer></body></html>"


@pytest.mark.parametrize(
    "inside, expected",
    [
        (f"<article><h1>A&amp;B</h1><p>{LONG}</p><p>short</p></article>", f"A&B\n{LONG.strip()}\nshort"),
        (f"<article><p>a <b>b</b>\n\n c<br>d<p>{LONG}<script>x('</p>')</script></article>", f"a b c d\n{LONG.strip()}"),
        (f"<main><div><p>{LONG}</p><aside>side</aside><form>f<input></form><p>end</p></div></main>", f"{LONG.strip()}\nend"),
        (f"<article><p>{LONG}</p><section class='comments'><p>{LONG}</p></section></article>", LONG.strip()),
        (f"<div class='x'><p>{LONG}</p><p>{LONG}</p></div><div class='cookie-notice'>{LONG}</div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<article><ul><li>one<li>two</ul><p>{LONG}</article>", f"one\ntwo\n{LONG.strip()}"),
        ("<article></article>", ""),
        ("", ""),
    ],
)
def test_main_text(inside, expected):
    assert main_text(page(inside)) == expected


@pytest.mark.parametrize(
    "inside, expected",
    [
        (f"<main><h1>T</h1><p>{LONG}</p><p>{LONG}</p></main><div><article><p>card</p></article></div>", f"T\n{LONG.strip()}\n{LONG.strip()}"),
        (f"<div><article><p>card</p></article></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<div><article><p>{LONG}</p></article><article><p>{LONG}</p></article></div>", f"{LONG.strip()}\n{LONG.strip()}"),
    ],
)
def test_the_region_holds_the_content_whatever_the_tags(inside, expected):
    assert main_text(page(inside)) == expected


@pytest.mark.parametrize("name", ["content no-sidebar", "site-main has-sidebar", "post comments-open", "page-with-menu", "menu"])
def test_a_name_does_not_remove_the_content(name):
    text = f"<div class='entry-header'><h1>Title</h1></div><p>{LONG}</p><div class='site-footer'>foot</div><p>{LONG}</p>"
    assert main_text(page(f"<div class='{name}'>{text}</div>")) == f"Title\n{LONG.strip()}\n{LONG.strip()}"


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<article><p>x &lt; y"), (3, None, "<article><p>x &lt; y"), (None, "u", "<<<>>>&&")]
    rows.append((5, "u", "<article>" + "<p>wörd</p>" * 20_000))
    got = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    found = [(r.page_id, r.n_chars) for r in got]
    assert found[:2] == [(1, 0), (2, 0)] and found[2:4] == [(3, 5)] * 2 and found[5] == (5, 20_000 * 5 - 1)
    empty = extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string, text string"))
    assert empty.collect() == []


def test_rules_against_plain_matching(spark):
    hosts = ["net", "a.net", "xnet", "example.net", "A.EXAMPLE.net", "example.com", "m.example.com", "org", "a.org", "ex.org.net", "de", "a.net.org"]
    paths = ["", "/", "/en/", "/en", "/de/x?y=/fr/", "/fr/1#z", "?q=/en/", "/x.net/", "/a/example.com/de/"]
    urls = [f"https://{h}{p}" for h in hosts for p in paths] + ["net/en/", "", None, "://", "http://net/://org/fr/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for row in judge_urls(df, URL_RULES).collect():
        url = urls[row.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (row.host, row.path) == (host, path)
        assert (row.rule, row.verdict) == ((best.name, best.verdict) if best else (None, "allow"))


def test_automaton_spans_words():
    rules = [Rule("block", f"host{i}.example", f"/path/{i}/") for i in range(40)]
    machine = Automaton([g for r in rules for g in r.globs()])
    assert machine.words > 10
    urls = [f"a.host{i}.example/path/{i}/x".encode() for i in range(40)]
    assert machine.patterns(machine.matches(urls)) == [[2 * i + 1] for i in range(40)]
    assert machine.patterns(machine.matches([])) == []


FURNITURE_NAMES = [
    "comment-list", "reader-comments", "user-comments", "comments-section", "comment-thread", "ad-300x250", "google-ad", "related-posts",
    "share-buttons", "site-alert", "alert", "promo-card", "newsletter-form", "cookie-policy-notice",
]


@pytest.mark.parametrize("name", FURNITURE_NAMES)
@pytest.mark.parametrize("tag", ["article", "div"])
def test_named_furniture_goes_even_inside_the_content(name, tag):
    text = f"<h1>T</h1><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div><p>{LONG}</p>"
    assert main_text(page(f"<{tag} class='x'>{text}</{tag}>")) == f"T\n{LONG.strip()}\n{LONG.strip()}"


def test_parts_of_an_article_side_by_side_stay_together():
    first, second = f"<p>{LONG}</p>" * 3, f"<p>{LONG}</p>"
    split = f"<div id='content'><h1>Title</h1><div>{first}</div><div>{second}</div></div>"
    assert main_text(page(split)) == "\n".join(["Title", *[LONG.strip()] * 4])
    deeper = f"<div><div><div>{first}</div></div><div><div>{second}</div></div></div>"
    assert main_text(page(deeper)) == "\n".join([LONG.strip()] * 4)
    beside = f"<div><ul><li><a>one</a><li><a>two</a></ul></div><div>{first}</div><div><a>more</a></div>"
    assert main_text(page(beside)) == "\n".join([LONG.strip()] * 3)


@pytest.mark.parametrize("html", ["<div>" * 50_000 + "<p>x", "<b>" * 50_000 + "x", "<div><p>x</p>" * 50_000, "</i>" * 50_000 + "<span>" * 50_000 + "x"])
def test_unclosed_elements_cost_their_number(html):
    import time

    begun = time.perf_counter()
    assert set(main_text(html).split("\n")) == {"x"}
    assert time.perf_counter() - begun < 20


def test_furniture_inside_a_block():
    assert main_text(page(f"<p>{LONG}<span class='share'>Share</span> end<select><option>o</select></p>")) == f"{LONG.strip()} end"
    assert main_text(page(f"<p>{LONG}</p><div hidden>gone</div><div role='alert'>gone</div>")) == LONG.strip()
