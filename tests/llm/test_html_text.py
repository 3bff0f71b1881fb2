import random
import time

import pytest
from hypothesis import given, settings, strategies as st

from noticehouse.llm import html_text
from noticehouse.llm.html_lines import DOUBT, MAIN, OTHER, lines_of
from noticehouse.llm.html_text import shared_lines

LINES = st.lists(st.sampled_from("abcde"), max_size=14)


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=500, deadline=None)
@given(LINES, LINES)
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    shared = [a[k] for k in sorted(shared_lines(a, b))]
    assert len(shared) == lcs_length(a, b)
    rest = iter(b)
    assert all(x in rest for x in shared)


def text(page):
    return [t for t, kind in lines_of(page) if kind in (MAIN, OTHER, DOUBT)]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a&amp;b&nbsp; &lt;c&gt; &#233;&#x41;</p>", ["a&b <c> éA"]),
        ("<p>one<p>two<br>three<b>four</b>", ["one", "two threefour"]),
        ("<article><h1>T</h1><p><b>T.<br><p>x</p></article><footer>f", ["T", "T.", "x"]),
        ("<p>a<!-- <p>b -->c</p><!-- open", ["ac"]),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><p>x</p><script>y", ["x"]),
        ("<nav><ul><li>m<li>n</ul></nav><ul><li>i<li>j</ul>", ["i", "j"]),
        ("<header>h</header><article><header>title</header><p>x</article>", ["title", "x"]),
        ('<div class="side-bar sidebar">s<div>t</div></div><div>u</div>', ["u"]),
        ('<article><p>x</p><section id="comments"><p>c</p></section><p>y</p></article>', ["x", "y"]),
        ('<p title="a > b" data-x=\'<p>\'>x</p>', ["x"]),
        ('<p title="unbalanced>x</p><p>y</p>', ["x", "y"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("a < b and c <3 d", ["a < b and c <3 d"]),
        ("<form><p>q</p></form><aside>w</aside><button>z</button>x", ["x"]),
        ("<p>x</p></div></div><p>y</p>", ["x", "y"]),
        ("<head><title>t</title></head><body>x</body>", ["x"]),
    ],
)
def test_lines(page, expected):
    assert text(page) == expected


def test_half_a_tag_is_no_text():
    assert text("<p>x</p><a href='y") == ["x"]


def extracted(spark, rows, **columns):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df = df.selectExpr("*", *(f"{v} as `{c}`" for c, v in columns.items()))
    found = html_text.extract_text(df).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return {r["page_id"]: r["text"] for r in found}


def test_shared_lines_of_a_site_go(spark):
    """No markup tells the site's lines from the page's."""
    rows = [
        (k, f"http://a.example/{k}", f"<div>Site</div><div>Latest: x</div><div>own {k}</div><div>more {k}</div><div>End</div>")
        for k in range(5)
    ]
    found = extracted(spark, rows)
    assert found == {k: f"own {k}\nmore {k}" for k in range(5)}


def test_copies_are_not_read_against_each_other(spark):
    page = "<div>Site</div><div>own text here</div><div>a good deal more of it</div><div>End</div>"
    other = "<div>Site</div><div>another page</div><div>with text of its own</div><div>End</div>"
    rows = [(k, f"http://a.example/x/{k}", page) for k in range(4)] + [(9, "http://a.example/y", other)]
    found = extracted(spark, rows)
    assert {found[k] for k in range(4)} == {"own text here\na good deal more of it"}
    assert found[9] == "another page\nwith text of its own"


def test_quoted_passages_stay(spark):
    rows = [
        (k, f"http://a.example/{k}", f"<div>Site</div><article><p>All rights reserved.</p><p>own {k}</p></article>")
        for k in range(3)
    ]
    assert extracted(spark, rows) == {k: f"All rights reserved.\nown {k}" for k in range(3)}


def test_odd_rows(spark, clashing):
    rows = [(1, None, "<p>a</p>"), (2, "http://h/", None), (None, "x", "<p>b</p>"), (3, "", ""), (3, "", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    df = df.selectExpr("*", "'h' as host", "'p' as path", *(f"{v} as `{c}`" for c, v in clashing.items()))
    found = sorted(map(tuple, html_text.extract_text(df).collect()), key=str)
    assert found == sorted(
        [(1, None, "a", 1), (2, "http://h/", "", 0), (None, "x", "b", 1), (3, "", "", 0), (3, "", "", 0)], key=str
    )
    assert html_text.extract_text(df.limit(0)).collect() == []


def test_a_long_page(spark):
    chance = random.Random(1)
    body = [f"line {chance.random()}" for _ in range(20_000)]
    rows = [(k, f"http://a.example/{k}", "<div>Site</div>" + "".join(f"<div>{x} {k}</div>" for x in body)) for k in (1, 2)]
    assert extracted(spark, rows)[1] == "\n".join(f"{x} 1" for x in body)


def brute(rows):
    """Pages in order, one by one: copies of all lines are one entry, groups begin
    where an entry is no copy of the one before."""
    parsed = {i: lines_of(source or "") for i, _, source in rows}
    host = {i: (u or "").split("//")[-1].split("/")[0] for i, u, _ in rows}
    path = {i: "/" + "/".join((u or "").split("//")[-1].split("/")[1:]) for i, u, _ in rows}
    first = {}
    for i in sorted(parsed, key=lambda i: (host[i], path[i], i)):
        first.setdefault((host[i], tuple(parsed[i])), i)
    entries = sorted(first.values(), key=lambda i: (host[i], path[i], i))
    groups = []
    for k, i in enumerate(entries):
        before = entries[k - 1] if k and host[entries[k - 1]] == host[i] else None
        own, kinds = [t for t, _ in parsed[i]], [kind for _, kind in parsed[i]]
        other = [t for t, _ in parsed[before]] if before is not None else None
        if before is None or not html_text.is_copy(own, list(map(len, own)), kinds, other):
            groups.append([])
        groups[-1].append(i)
    texts = {}
    for k, group in enumerate(groups):
        near = [g for g in (groups[k - 1][-1:] if k else []) if host[g] == host[group[0]]]
        near = near or [g for g in (groups[k + 1][:1] if k + 1 < len(groups) else []) if host[g] == host[group[0]]]
        other = [t for t, _ in parsed[near[0]]] if near else []
        for i in group:
            shared = shared_lines([t for t, _ in parsed[i]], other)
            texts[host[i], tuple(parsed[i])] = "\n".join(
                t for n, (t, kind) in enumerate(parsed[i])
                if kind == MAIN or kind in (OTHER, DOUBT) and n not in shared
            )
    return {i: texts[host[i], tuple(parsed[i])] for i in parsed}


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_partitions_change_nothing(spark, parts, monkeypatch):
    """Copies, near copies and hosts, dealt over any number of partitions."""
    monkeypatch.setattr(html_text, "BLOCK", 16)
    rng = random.Random(8)
    rows = []
    for k in range(150):
        host = rng.choice(["hot.example"] * 3 + ["b.example", "c.example"])
        kind = rng.randrange(4)
        long = " ".join(["the same long passage in all copies"] * 9)
        own = {0: long, 1: f"{long}</p><p>{k}", 2: f"own {k} text", 3: f"other {k} text"}[kind]
        rows.append((k, f"http://{host}/{k:04}", f"<p>Site of {host}</p><p>{own}</p><p>About us</p><nav>m</nav>"))
    held = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert extracted(spark, rows) == brute(rows)
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize(
    "part",
    ["<svg><p>x</p>", "<a <b ", '<a "', "<a '\"", "<b><i></u>", "<script>", "<!--x", "<button>y", "</p <", "<form><h1>",
     "<article><div>", "<", "<a href=x", "<title>", "<p class='notice'>", "<script src=a/>", "&amp", "<![CDATA["],
)
def test_broken_markup_takes_time_in_proportion(part):
    page = part * ((1 << 20) // len(part))
    start = time.process_time()
    lines_of(page)
    assert time.process_time() - start < 8


def test_an_article_keeps_what_classes_only_suggest(spark):
    page = (
        "<article><p>One <a class='share'>word</a> of it</p><div class='dialog'><p>Who is there?</p></div>"
        "<ul class='menu'><li>Soup of the day</li></ul><div class='notice-board'>A board {k}</div>"
        "<ul class='menu'><li><a href=x>Home</a></li></ul><div class='notice'>Shared notice</div></article>"
    )
    assert text(page) == [
        "One word of it", "Who is there?", "Soup of the day", "A board {k}", "Shared notice",
    ]
    rows = [(k, f"http://a.example/{k}", page.replace("{k}", str(k)) + f"<p>own {k} and much more of it</p>") for k in (1, 2)]
    found = extracted(spark, rows)[1].split("\n")
    assert "A board 1" in found and "One word of it" in found and "Shared notice" not in found


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<body class='has-sidebar'><p>x</p></body>", ["x"]),
        ("<article class='post comments-open'><p>x</p></article>", ["x"]),
        ("<div class='widget'><main><p>x</p></main></div>", ["x"]),
        ("<form id='aspnetForm'><nav>m</nav><h1>t</h1><p>x</p></form>", ["t", "x"]),
        ("<form><article><p>x</p></article></form><form><p>q</p></form>", ["x"]),
        ("<article><h2 id='related-work'>h</h2><section id='discussion'><p>x</p></section></article>", ["h", "x"]),
        ("<section id='discussion'><p>c</p></section><p>x</p>", ["x"]),
        ("<article><p>a</p><img class='share'><p>b</p></article>", ["a", "b"]),
        ("<head><title>t</title><meta name=a><body><p>x</p>", ["x"]),
        ("<head><title>t</title><p>x</p>", ["x"]),
        ("<aside><article>teaser</article></aside><p>x</p>", ["x"]),
        ("<p>a</p><svg/><p>b</p><iframe src='u/v' /><p>c</p>", ["a", "b", "c"]),
        ("<script src='a.js'/><p>x</p>", ["x"]),
        ("<script src=a/>var x</script><p>x</p>", ["x"]),
        ("<p>a</p><button>z<p>x</p><button>y</button><p>b</p>", ["a", "x", "b"]),
        ("<svg><text>i</text></svg><p>x</p><select><option>s", ["x"]),
    ],
)
def test_nothing_else_is_set_apart(page, expected):
    assert text(page) == expected
