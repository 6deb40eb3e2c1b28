import html
import random
import re

import pandas as pd

from tempolith.llm import decontaminate, html_main
from tests.llm.helpers import awkward, clashing, frame, words

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body class=home><header><h1>Site</h1></header><nav><a href=/>menu</a></nav>
<div id=content><div class="post-{k} entry"><header><h2>Head {k}</h2></header><p>Caf&eacute; <i>x</i>y {body}.<p>Two&nbsp;&lt;b&gt;<div class="ad-box">BUY</div><ul><li>a<li>b</ul>
<form><input value=q>F<button>Go</button></form><table><tr><td>c1<td>c2</table><blockquote>q<br>r</blockquote><p hidden>no</p></div>
<div class="comments"><p>reader words reader words reader words reader words reader words reader words reader words reader words {body}</p></div></div>
<aside>side</aside><footer>foot</footer></body></html>"""


def test_pages_against_a_plain_reading(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    got = html_main.op6_html(spark, SF).collect()
    assert len(got) == len(pages)
    for row in got:
        inner = re.search(r"<article>(.*?)</article>", pages.loc[row.page_id, "html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?:/?p|/?h1|br|/?div)[^>]*>", " ", inner))).split())
        assert row.text == want and row.n_chars == len(want)


def test_hosts_agree_on_a_path(spark):
    body = "some words of the article that say a little more than the rest of the page does"
    # on the last page the comments are longer than the article, which its host's path still finds
    rows = [(k, f"https://u@Host.example:80/{k}", PAGE.format(k=k, body=body), "x") for k in range(6)]
    rows.append((6, "https://host.example/6", PAGE.format(k=6, body="short").replace("reader words", "reader words " * 20), "x"))
    rows += [(7, None, None, None), (8, "https://host.example/e", "", None), (9, "not a url", "plain <b>text", None), (9, "not a url", "plain <b>text", None),
             (None, "https://host.example/n", "<p>unclosed <a href=\"x>bad", None), (10, "https://long.example", "<p>" + "word " * 50000 + "<div>" * 3000, None)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = html_main.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    for k in range(7):
        want = f"Café xy {body if k < 6 else 'short'}. Two <b> a b c1 c2 q r"
        assert text[k] == want
    assert text[7] == text[8] == "" and text[9] == "plain text" and text[None] == "unclosed bad" and len(text[10]) == 249999
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_main.main_text(pages.filter("false")).count() == 0


def test_wrappers_that_mention_boilerplate_keep_the_article():
    text = "A long enough sentence of the article, with some words more."
    body = f"<h1>Head</h1><p>{text}</p><p>{text}</p>"
    want = f"Head {text} {text}"
    side = '<div class="sidebar-left"><p>side words</p></div><div class="post-comments"><article class="comment-body"><p>reader words</p></article></div>'
    side += '<section class="related"><article><h3>Other</h3><p>teaser</p></article></section><div id="ad300"><p>BUY</p></div>'
    for mark in ('class="layout has-sidebar"', "class=no-comments", "class=with-nav", "class=elementor-widget-container", "id=search-page", "class='page--with-sidebar'", "class=sidebar-left",
                 "class=widget", 'class="content menu"'):
        for inner in (f"<article>{body}</article>", f"<main>{body}</main>", f"<div>{body}</div>"):
            assert html_main.extract(f"<body><div {mark}>{inner}</div></body>", None) == want, (mark, inner)
        # what stands beside the article inside the wrapper is still left out
        page = f"<body><div {mark}><article>{body}</article>{side}</div><footer>f</footer></body>"
        assert html_main.extract(page, None) == want and html_main.extract(page, html_main.vote(page)[0]) == want, mark
    # comments stay out though they are longer, and a page of nothing else keeps its text
    assert html_main.extract(f"<div class=post>{body}</div><div class=comments><p>{'reader ' * 40}</p></div>", None) == want
    assert html_main.extract(f"<div class=comments>{body}</div>", None) == want


def test_layouts_of_div_keep_heading_lead_and_closing(spark):
    text = "A long enough sentence of the article, with some words more than the rest."
    body = f"<div class=body><p>{text}</p><p>{text}</p><p>{text}</p></div>"
    other = '<div class=links><a href=/a>One other page to read</a><a href=/b>And one more page of this host</a></div>'
    lead, end = "<p>The lead of it.</p>", "<div class=end><p>Some closing words of the writer, about a fifth of it.</p></div>"
    want = f"{text} {text} {text}"
    tail = "Some closing words of the writer, about a fifth of it."
    cases = [(f"<div class=post><h1>Title</h1>{body}</div>{other}", f"Title {want}"), (f"<div class=post><h1>Title</h1>{lead}<div class=wrap>{body}</div>{end}</div>{other}", f"Title The lead of it. {want} {tail}"),
             (f"<div class=post><div class=top><h1>Title</h1><p>By <a href=/w>the writer</a></p></div>{body}{end}</div>{other}", f"Title By the writer {want} {tail}"),
             (f"<div class=post>{body}{other}</div>", want), (f"<div class=post><h2>Head</h2>{body}</div><div class=comments><p>reader words</p></div>{other}", f"Head {want}")]
    for page, found in cases:
        assert html_main.extract(f"<body>{page}</body>", None) == found, page
    # most pages of the host have only the inner container, which the others share
    rows = [(k, "http://a.example/", f"<body><div class=post>{body}</div>{other}</body>") for k in range(5)] + [(9, "http://a.example/", f"<body>{cases[0][0]}</body>")]
    got = {r.page_id: r.text for r in html_main.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == want for k in range(5)) and got[9] == f"Title {want}"


def test_paths_that_tie_give_the_same_text_on_every_run(spark):
    """Two containers of one score and a host whose pages vote half and half: one answer, whatever the partitions."""
    text = "A long enough sentence of the article, with some words more than the rest."
    body = f"<p>{text}</p><p>{text}</p>"
    twins = f"<body><div class=one>{body}</div><div class=two>{body}</div></body>"
    rows = [(k, "http://tie.example/", twins) for k in range(6)]
    rows += [(10 + k, "http://half.example/", f"<body><div class={'left' if k % 2 else 'right'}>{body}</div></body>") for k in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [{r.page_id: r.text for r in html_main.main_text(df.repartition(n)).collect()} for n in (1, 4, 7)]
    assert got[0] == got[1] == got[2]
    assert {got[0][10 + k] for k in range(6)} == {f"{text} {text}"} and len({got[0][k] for k in range(6)}) == 1 and text in got[0][0]


def test_edited_copies_are_found_and_clean_rows_left(spark):
    r = random.Random(9)
    tests = [(k, " ".join(words(r, r.randrange(15, 60)))) for k in range(12)] + [(50, None), (51, ""), (52, "w1 w2"), (None, " ".join(words(r, 20))), (0, " ".join(words(r, 30)))]
    rows, planted = awkward(), set()
    for n, (k, t) in enumerate(x for x in tests[:12] for _ in range(3)):
        w = t.split()
        edited = [r.choice(["new", "other"]) if r.random() < 0.15 * (n % 3) / 2 else x for x in w]
        rows.append((8000 + n, " ".join(words(r, 40) + edited + words(r, 40)).upper().replace(" ", ", "), "en", "a", 0))
        planted.add((8000 + n, k))
    rows.append((8100, " ".join(words(r, 40000)) + " " + tests[3][1], "en", "a", 0))
    planted.add((8100, 3))
    docs, items = frame(spark, rows, clash=True), clashing(spark.createDataFrame(tests, "item_id long, text string"))
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, items).collect()}
    assert got == planted
    sliced = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, items, item_bytes=700).collect()}
    assert sliced == planted
    left = decontaminate.decontaminated(docs, items)
    assert left.columns == docs.columns and left.count() == len(rows) - len({d for d, _ in planted})
    assert decontaminate.contaminated(docs, items.filter("false")).count() == 0 and decontaminate.contaminated(frame(spark, []), items).count() == 0


def test_a_common_item_is_found_in_every_document(spark):
    r = random.Random(4)
    passage = " ".join(words(r, 25))
    rows = [(k, " ".join(words(r, 30)) + " " + passage, "en", "a", 0) for k in range(200)] + [(900 + k, " ".join(words(r, 60)), "en", "a", 0) for k in range(50)]
    got = decontaminate.contaminated(frame(spark, rows), spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(x.doc_id for x in got.collect()) == list(range(200))


def test_short_unspaced_and_long_items(spark):
    r = random.Random(12)
    long = " ".join(words(r, 300))
    chinese = "床前明月光，疑是地上霜。举头望明月，低头思故乡。"
    tests = [(1, "Rarest"), (2, "two words"), (3, "three such words"), (4, "w1 and four words"), (5, chinese), (6, long), (7, "どうもありがとう ございました 皆さん"), (2, "two words")]
    hold = {1: "the rarest of all", 2: "these Two, words!", 3: "here three such words stand", 4: "or w1 and FOUR words", 5: f"前言{chinese.replace('，', ' ')}后语", 6: " ".join(long.split()[120:220]),
            7: "あのどうもありがとうございました皆さん、では"}
    rows = [(k, " ".join(words(r, 30)) + " " + t + " " + " ".join(words(r, 30)), "en", "a", 0) for k, t in hold.items()]
    rows += [(100, "two other words and three such things", "en", "a", 0), (101, "rarestof two-three", "en", "a", 0), (102, "明天月光 床前 故事", "zh", "a", 0),
             (103, " ".join(long.split()[:15]), "en", "a", 0), (104, None, None, None, 0)]
    docs, items = frame(spark, rows), spark.createDataFrame(tests, "item_id long, text string")
    got = [(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, items).collect()]
    assert sorted(got) == [(k, k) for k in hold]
    assert sorted(x.doc_id for x in decontaminate.decontaminated(docs, items, item_bytes=200).collect()) == [100, 101, 102, 103, 104]


def test_all_pairs_by_the_textbook(spark):
    """Brute force: every document against every item by plain Smith-Waterman, no seeds."""
    import numpy as np
    r = random.Random(21)
    tests = [(k, words(r, r.choice([3, 9, 14, 30, 70, 130]), 60)) for k in range(14)]
    docs = []
    for k in range(90):
        own = words(r, 40, 60)
        if k % 2:
            item = r.choice(tests)[1]
            a = r.randrange(max(1, len(item) // 2))
            part = item[a:a + r.randrange(3, len(item) + 1)]
            part = [w if r.random() > 0.12 else r.choice(["new", ""]) for w in part]
            own[20:20] = part
        docs.append((k, [w for w in own if w]))

    def plain(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        return h.max() / (2 * len(a))

    runs = lambda w: {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    want, unseeded = set(), set()
    for d, text in docs:
        for i, item in tests:
            if decontaminate.enough((d, i, plain(item, text), 0, 0, len(item)), decontaminate.THRESHOLD):
                (want if runs(item) & runs(text) else unseeded).add((d, i))
    assert len(want) >= 20
    df = frame(spark, [(d, " ".join(t), "en", "a", 0) for d, t in docs])
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(df, spark.createDataFrame([(i, " ".join(t)) for i, t in tests], "item_id long, text string")).collect()}
    assert got <= want | unseeded and want - got == set()


def test_choosing_seeds_takes_time_in_proportion(monkeypatch):
    import time
    r = random.Random(3)
    took = []
    for n in (4000, 32000):
        items = decontaminate.Items(list(range(n)), [" ".join(words(r, 20, 10**6)) for _ in range(n)])
        counts = dict.fromkeys(items.gram.view("int64").tolist(), 2)
        start = time.thread_time()
        items.choose(counts, 10)
        took.append(time.thread_time() - start)
        assert len(items.gram) == 18 * n
    assert took[1] < 30 * max(took[0], 0.005)


def test_alignment_against_the_textbook():
    import numpy as np
    r = random.Random(2)
    for _ in range(40):
        a, b = ([r.randrange(5) for _ in range(r.randrange(1, 12))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))[0] == max(map(max, h))
