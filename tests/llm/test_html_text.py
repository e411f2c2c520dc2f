import re
import time
from html import unescape

import numpy as np

from daybeat.llm import html_text as h
from daybeat.llm.catalog import QUERIES

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def article(source):
    """Text of the article of a generated page: blocks end at p, h1 and br stands for a space."""
    body = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
    return "\n".join(filter(None, (" ".join(unescape(b).split()) for b in blocks)))


def test_query_gives_the_articles_of_all_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = QUERIES["op3_html_text"](spark, SMALL).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def text_of(source):
    return h.main_texts([source])[0][0]


def test_markup_cases():
    assert text_of("") == "" and text_of("   plain &amp; simple ") == "plain & simple"
    assert text_of("<p>a<p>b<br>c</p><div>d</div>") == "a\nb c\nd"
    assert text_of("<article><p>x &lt;b&gt; &#233;&nbsp;&eacute; &unknown; AT&amp</article><p>out</p>") == "x <b> é é &unknown; AT&"
    assert text_of('<script>var t="</p><p>no";</script><style>p{}</style><p>yes') == "yes"
    assert text_of("<script>never closed <p>no") == ""
    assert text_of("<!-- <p>no</p> --><p>yes</p><!-- open") == "yes"
    assert text_of('<p title="a > b">yes</p><p title="open>also</p>') == "yes\nalso"
    assert text_of("<p>cut <a href=") == "cut"
    assert text_of("<nav>no<div>no</div></nav><main><p>yes</p><aside>no</aside><form>no</form></main><p>no</p>") == "yes"
    for mark in ("ad", "sidebar", "cookie-notice", "comments", "main-nav", "footer"):
        assert text_of(f'<article><p>yes</p><div class="{mark}"><p>no</p></div><p>yes</p></article>') == "yes\nyes"
    assert text_of('<article><p>yes</p><section id=comments><p>no</article><p>no') == "yes"
    assert text_of("<p>1 < 2 and a<b</p>").startswith("1 < 2 and a")


def test_repeated_runs_go_where_nothing_is_marked():
    menu = "<div>Home About Contact Imprint Privacy Terms Help Jobs Press</div>"
    pages = [f"{menu}<p>{' '.join(f'own{k}word{j}' for j in range(20))}</p>" for k in range(4)]
    texts, removed = h.main_texts([*pages, pages[0]])
    for k in range(4):
        assert texts[k] == " ".join(f"own{k}word{j}" for j in range(20))
    assert texts[4] == texts[0] and removed[0] == ["Home About Contact Imprint Privacy Terms Help Jobs Press"]


def test_repeated_equals_brute_force():
    rng = np.random.default_rng(3)
    streams = [rng.integers(0, 3, n) for n in (0, 5, 30, 60, 60)] + [np.arange(40) + 10]
    streams.append(streams[-1].copy())
    want = []
    for k, own in enumerate(streams):
        covered = np.zeros(len(own), bool)
        for i in range(len(own) - h.RUN + 1):
            run = own[i:i + h.RUN].tobytes()
            kinds = {s.tobytes() for s in streams for j in range(len(s) - h.RUN + 1) if s[j:j + h.RUN].tobytes() == run}
            if len(kinds) >= h.PAGES_OF_RUN:
                covered[i:i + h.RUN] = True
        want.append(covered)
    for a, b in zip(h.repeated(streams), want):
        assert np.array_equal(a, b)


def test_awkward_rows_chunks_and_empty_table(spark, monkeypatch):
    long = "<article>" + "<p>paragraph of text</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "no host", ""), (None, "http://a.b/c", "<p>x</p>"), (3, "http://a.b/d", long),
            (4, "http://a.b/e", "<p>y</p>"), (4, "http://a.b/e", "<p>y</p>")]
    df = spark.createDataFrame([(*r, "own") for r in rows], PAGES + ", text string")
    monkeypatch.setattr(h, "CHUNK_PAGES", 2)
    found = h.extract(df).collect()
    assert sorted((str(r.page_id), len(r.text)) for r in found) == sorted(
        [("1", 0), ("2", 0), ("None", 1), ("3", 20_000 * 18 - 1), ("4", 1), ("4", 1)])
    assert h.extract(df.limit(0)).count() == 0


def test_loose_marks_do_not_hide_articles():
    for name in ("content has-sidebar", "no-ads", "ad-free", "site-search-results", "with-header", "share-story", "sidebar"):
        assert text_of(f'<div class="{name}"><article><p>yes</p></article></div><p>no</p>') == "yes", name
        assert text_of(f'<div class="{name}"><p>{"yes " * 20}</p></div><p>more</p>') == " ".join(["yes"] * 20) + "\nmore", name
    assert text_of("<form><nav>no</nav><article><p>yes</p></article><aside>no</aside></form>") == "yes"
    assert text_of("<form><nav>no</nav><p>yes yes</p></form>") == "yes yes"
    # A teaser beside the article stays out, and so does a long menu.
    assert text_of("<article>yes</article><aside><article>teaser</article></aside>") == "yes"
    assert text_of(f"<nav>{'no ' * 30}</nav><p>yes</p>") == "yes"
    assert text_of('<p>a <span class="ad-box">no</span> b</p>' + "<p>more text</p>") == "a b\nmore text"


def test_large_hosts_lose_the_runs_of_two_pages(spark, monkeypatch):
    """Each notice stands on two pages; chunks change nothing, repeated rows are one page."""
    own = lambda k: " ".join(f"own{k}word{j}" for j in range(20))
    notice = lambda k: " ".join(f"notice{k // 2}word{j}" for j in range(12))
    pages = [(k, f"http://a.b/{k}", f"<div>{notice(k)}</div><p>{own(k)}</p>") for k in range(60)]
    pages += [pages[0], (99, "http://c.d/1", pages[2][2]), (99, "http://c.d/1", pages[2][2])]
    df = spark.createDataFrame(pages, PAGES)
    got = []
    for size in (1000, 4):
        monkeypatch.setattr(h, "CHUNK_PAGES", size)
        got.append(sorted((r.page_id, r.text, tuple(r.removed)) for r in h.extract(df).collect()))
    assert got[0] == got[1] and len(got[0]) == 63
    for k, text, removed in got[0]:
        assert (text, removed) == ((own(k), (notice(k),)) if k < 60 else (f"{notice(2)}\n{own(2)}", ()))
    texts, removed = h.main_texts([p[2] for p in pages[:60]])
    assert [(k, text, tuple(gone)) for k, (text, gone) in enumerate(zip(texts, removed))] == [r for r in dict.fromkeys(got[0]) if r[0] < 60]


def test_unmatched_end_tags_take_time_in_proportion():
    def seconds(n):
        source = "<div>" * n + "text" + "</section>" * n
        start = time.process_time()
        assert h.parse(source).blocks == ["text"]
        return time.process_time() - start

    seconds(1_000)
    small = min(seconds(5_000) for _ in range(3))
    assert min(seconds(20_000) for _ in range(2)) < 10 * max(small, 0.01)
    assert text_of("<div><article><p>kept</section></p></article></div></div><p>after</p>") == "kept"


def test_lines_of_most_pages_leave_marked_articles(spark, monkeypatch):
    """Against brute force over whole hosts: a letter on all pages goes, whatever the chunks; copies and quotes stay."""
    own = lambda k: " ".join(f"own{k}word{j}" for j in range(20))
    letter = "Sign up for our weekly letter and get the news of all seven days"
    quote = "a stock line that some of the articles on this host close with"
    pages = []
    for host, parts in (("a.b", lambda k: [own(k), letter, *[quote] * (k % 3 == 0)]), ("c.d", lambda k: [own(0), own(1), letter]),
                        ("e.f", lambda k: [own(k), *[letter] * (k % 2)]), ("g.h", lambda k: [own(k), *[letter] * (k % 2 or k > 25)])):
        pages += [(len(pages) + k, host, [*parts(k), *[f"end {k}"] * (host == "c.d")]) for k in range(30)]
    pages += [(900, "i.j", [own(1), letter]), (901, "i.j", [own(2), letter])]
    pages += [(id, host, blocks) for id, host, blocks in pages if id == 90 for _ in range(40)]      # one page again and again

    def runs(blocks):
        tokens = [t for b in blocks for t in (*b.split(" "), "")]
        return {tuple(tokens[i:i + h.RUN]) for i in range(len(tokens) - h.RUN + 1)}

    want = []
    for id, host, blocks in pages:
        kinds = {tuple(b) for _, other, b in pages if other == host}
        shared = {r for r in runs(blocks) if (n := sum(r in runs(k) for k in kinds)) >= h.PAGES_OF_LINE and 2 * n > len(kinds)}
        hashes = {h.run_hashes([" ".join(r)])[0] for r in shared if "" not in r}
        gone = [b for b in blocks if hashes and h.without_runs([b], np.sort(np.array(list(hashes), np.uint64))) == [False]]
        if 2 * sum(len(b.split()) for b in gone) > sum(len(b.split()) for b in blocks):
            gone = []
        want.append((id, "\n".join(b for b in blocks if b not in gone), tuple(gone)))
    assert {w[2] for w in want if w[0] < 30 or 90 <= w[0] < 120} == {(letter,), ()} and {w[2] for w in want if 30 <= w[0] < 90} == {()}
    df = spark.createDataFrame([(id, f"http://{host}/{id}", "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>")
                                for id, host, blocks in pages], PAGES)
    for size in (1000, 4):
        monkeypatch.setattr(h, "CHUNK_PAGES", size)
        assert sorted((r.page_id, r.text, tuple(r.removed)) for r in h.extract(df).collect()) == sorted(want)


def test_runs_of_pages_have_the_hashes_of_their_words():
    pages = [["a b c d e f g h i", "x"], ["b c d e f g h i", "y"], [], ["a b c d e f g h i", "x"]]
    run, n, least, most, kinds = h.runs_of(pages)
    got = dict(zip(run.tolist(), zip(n.tolist(), (least < most).tolist())))
    assert kinds == 3 and got[h.run_hashes(["b c d e f g h i"])[0]] == (2, True)
    assert set(got) == {x for p in pages for x in h.run_hashes(p).tolist()}
    assert sorted(v[0] for v in got.values()).count(2) == 2     # the run and the one with its block's end
