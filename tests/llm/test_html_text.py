import html
import random
import re

import numpy as np

from tablefit.llm import html_text
from tablefit.llm.common import table

SF001 = "/root/testdata/sf0.001"


def article(page):
    """The text of the article element by plain cutting, for pages of the test data."""
    body = page[page.index("<article>") : (page + "</article>").index("</article>")]
    body = re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", re.sub(r"<[^>]*\Z", "", body))
    blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"<[^>]*>", body)]
    return " ".join(b for b in blocks if b)


def test_all_pages_of_the_test_data(spark):
    pages = {r.page_id: r for r in table(spark, SF001, "pages").collect()}
    rows = html_text.op10_html_text(spark, SF001).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html), r.page_id
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def brute(streams, min_run, min_pages):
    seen = {}
    for p, s in enumerate(streams):
        for i in range(len(s) - min_run + 1):
            seen.setdefault(tuple(s[i : i + min_run]), set()).add(p)
    out = []
    for s in streams:
        mark = [False] * len(s)
        for i in range(len(s) - min_run + 1):
            if len(seen[tuple(s[i : i + min_run])]) >= min_pages:
                mark[i : i + min_run] = [True] * min_run
        out.append(mark)
    return out


def test_repeated_runs_against_brute_force():
    rnd = random.Random(10)
    for _ in range(60):
        streams = [[rnd.randrange(1, 4) for _ in range(rnd.randrange(0, 40))] for _ in range(rnd.randrange(1, 8))]
        for run, pages in ((1, 2), (3, 2), (5, 3), (8, 2), (9, 2)):
            got = html_text.covered_by_repeats([np.array(s, np.int64) for s in streams], run, pages)
            assert [g.tolist() for g in got] == brute(streams, run, pages)


def test_blocks():
    def main(page):
        return " ".join(t for t, k in html_text.blocks_of(page) if k == html_text.MAIN)

    assert main("<article><h1>T&amp;t</h1><p>a <b>b</b>c\n\t d<br>e<p>f &lt;p&gt; 1 < 2</article><p>out") == "T&t a bc d e f <p> 1 < 2"
    assert main("<main>x<aside>y</aside><div class='related posts'>z</div></main>") == "x"
    assert main("<main><div id=comments><article>c</article></div><article><header>h</header>x<footer>f</footer></article></main>") == "h x"
    assert main("<article>a<script>var t='</p>';</script><style>p{}</style><!-- <p>no --><form>f</form><div class=thread>b</div></article>") == "a b"
    assert main("<article>a<p title='x > y'>b<p") == "a b"
    assert main("<article>a<!-- open") == "a"
    assert main("") == main(None) == main("plain") == ""


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    rnd = random.Random(2)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    menu, notice = "".join(f"<li>item {i}</li>" for i in range(10)), words(30)
    own = [words(40) for _ in range(40)]
    rows = [(i, f"http://h{'.big' if i % 2 else '.small'}/{i}", f"<div><ul>{menu}</ul></div><div>{t}</div><div>{notice}</div><nav>{words(9)}</nav>")
            for i, t in enumerate(own)]
    rows += [(100, "http://alone/x", f"<ul>{menu}</ul>{words(9)}"), (101, None, None), (102, "http://alone/y", ""), (103, "http://alone/z", "<p>&nbsp;")]
    rows += [(39, *rows[39][1:]), (None, "http://h.big/n", f"<p>{words(3)}</p><div>{notice}</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "'t' AS text", "2 AS part")
    kept, html_text.GROUP_PAGES = html_text.GROUP_PAGES, 10
    got = html_text.main_text(df).collect()
    html_text.GROUP_PAGES = kept
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert all(texts[i] == t for i, t in enumerate(own))
    assert texts[100].startswith("item 0 item 1") and texts[101] == texts[102] == texts[103] == ""
    assert len(texts[None].split()) == 3


def test_long_page_and_empty_table(spark):
    long = "<article>" + "<p>word word</p>" * 30_000 + "<" * 20_000 + "</article>" + "<div>" * 20_000
    df = spark.createDataFrame([(1, "http://a/b", long)], "page_id long, url string, html string")
    assert len(html_text.main_text(df).first().text.split()) >= 60_000
    assert html_text.main_text(df.limit(0)).count() == 0


def test_runs_on_few_pages_of_a_large_host_are_found_across_groups(spark, monkeypatch):
    rnd = random.Random(4)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    notice, copied = words(20), words(40)
    own = [words(30) for _ in range(120)]
    rows = [(i, f"http://large/{i}", f"<div>{t}</div>" + (f"<div>{notice}</div>" if i in (3, 70) else "")) for i, t in enumerate(own)]
    rows += [(200 + i, f"http://large/copy{i}", f"<div>{copied}</div>") for i in range(30)]
    rows += [(300, "http://other/1", f"<div>{notice}</div>")]  # another host's page doesn't count
    monkeypatch.setattr(html_text, "GROUP_PAGES", 4)
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == t for i, t in enumerate(own))
    assert all(got[200 + i] == copied for i in range(30)) and got[300] == notice


def test_repeated_runs_are_cut_inside_blocks(spark):
    rnd = random.Random(6)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    long, short = words(40), words(10)
    own = [(words(12), words(30)) for _ in range(6)]
    rows = [(i, f"http://h/{i}", f"<p>{a} {long}</p><p>{b} {short}</p>") for i, (a, b) in enumerate(own)]  # most and a little of a block
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{a} {b}" for i, (a, b) in enumerate(own)}


def test_articles_stay_whole_on_hosts_of_any_size(spark):
    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    notice, copied = words(20), words(40)
    own = [words(30) for _ in range(60)]
    rows = [(i, f"http://h/{i}", f"<main><p>{t} {notice}</p></main>") for i, t in enumerate(own)]
    rows += [(100 + i, f"http://copies/{i}", f"<nav>{words(9)}</nav><article>{copied}</article>") for i in range(300)]
    for parts in (1, 7):  # whatever the batches hold
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
        assert all(got[i] == f"{t} {notice}" for i, t in enumerate(own)) and all(got[100 + i] == copied for i in range(300))


def test_marks_around_and_on_the_article():
    def main(page):
        return " ".join(t for t, k in html_text.blocks_of(page) if k == html_text.MAIN)

    text = "<h1>Title</h1><p>Some words of the article that are longer than the menu.</p>"
    want = "Title Some words of the article that are longer than the menu."
    for page in (
        f"<body><div class='content-sidebar-wrap'><main><article>{text}</article></main><div class=sidebar>s</div></div>",
        f"<article class='post share-enabled'>{text}</article>",
        f"<body><form id=aspnetForm><div id=menu>m</div><article>{text}<div class=share>x</div></article></form>",
        f"<nav><ul><li>home<li>news</ul><main><article>{text}</article></main>",
        f"<body class='sidebar-left'><main class='site-header'>{text}<aside>a</aside></main></body>",
        f"<div class='post comments-open'><article>{text}</article></div>",
        f"<main><div class='notice-wrap'><article>{text}</article></div></main>",
        f"<article>{text}</article><div id=comments><article class=comment-body>c {text}</article></div>",
        f"<main><article>{text}</article><aside><article>teaser {text}</article></aside></main>",
    ):
        assert main(page) == want, page
    # what is no article of the page: teasers beside plain text, comments alone
    plain = "<div>" + "plain text of the page itself, much longer than all the rest of it " * 4 + "</div>"
    for page in (f"{plain}<aside><article>teaser</article></aside>", f"{plain}<div id=comments><article>short</article></div>"):
        kinds = dict((t[:6], k) for t, k in html_text.blocks_of(page))
        assert kinds.pop("plain ") == html_text.OPEN and set(kinds.values()) == {html_text.MARKED}


def plain_main_text(rows):
    """The whole operator without groups, hashes or suffix arrays."""
    hosts = {}
    for page_id, url, page in rows:
        m = re.search(r"://([^/?#]*)", url or "")
        hosts.setdefault(m[1].lower() if m else "", []).append((page_id, html_text.blocks_of(page)))
    out = []
    for pages in hosts.values():
        streams = {tuple(t for t, _ in blocks) for _, blocks in pages}
        seen = {}
        for stream in streams:
            tokens = " ".join(stream).split(" ")
            for i in range(len(tokens) - 7):
                seen.setdefault(tuple(tokens[i : i + 8]), set()).add(stream)
        for page_id, blocks in pages:
            kinds = [k for t, k in blocks for _ in t.split(" ")]
            tokens = [w for t, _ in blocks for w in t.split(" ")]
            covered = [False] * len(tokens)
            for i in range(len(tokens) - 7):
                if len(seen[tuple(tokens[i : i + 8])]) > 1:
                    covered[i : i + 8] = [True] * 8
            if html_text.MAIN in kinds:
                keep = [w for w, k in zip(tokens, kinds) if k == html_text.MAIN]
            else:
                keep = [w for w, k, c in zip(tokens, kinds, covered) if k == html_text.OPEN and not c]
            out.append((page_id, " ".join(keep)))
    return sorted(out)


def test_whole_operator_equals_a_plain_version(spark, monkeypatch):
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(60)}"
    passages = [" ".join(word() for _ in range(rnd.randrange(8, 25))) for _ in range(12)]
    rows = []
    for i in range(240):
        parts = [f"<{rnd.choice(['p', 'div', 'nav', 'div class=menu'])}>{rnd.choice([rnd.choice(passages), ' '.join(word() for _ in range(12))])}" for _ in range(4)]
        wrap = rnd.choice(["{}", "{}", "{}", "<article>{}</article>", "<div>{}</div>"])
        rows.append((i, f"http://h{rnd.choice([0, 0, 0, 1, 2, i])}/{i}", wrap.format("".join(parts))))
    rows += [(1000 + i, "http://h0/copy", rows[0][2]) for i in range(60)]
    monkeypatch.setattr(html_text, "GROUP_PAGES", 16)
    df, want = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), plain_main_text(rows)
    for chars in (html_text.BROADCAST_CHARS, 10):  # hosts sent to all tasks, and joined by a shuffle
        monkeypatch.setattr(html_text, "BROADCAST_CHARS", chars)
        assert sorted((r.page_id, r.text) for r in html_text.main_text(df).collect()) == want
