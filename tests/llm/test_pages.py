"""Pages: main text and archives, with the awkward rows."""

from __future__ import annotations

import hashlib
import io
import random
import time
from collections import Counter

import pytest

from labelloom.llm import html, warc

SCHEMA = "page_id long, url string, html string, text string, run string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_article_only():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style></head><body>
    <nav><ul><li><a href="/">Home page</a></li></ul></nav><script>var t="</p><p>no</p>";</script>
    <div class="cookie-notice">We use cookies</div><div class="ad">Buy now, it is cheap and long enough to look like text.</div>
    <article><h1>A &amp; B</h1><p><b>First&nbsp;part<br>goes   on.</b><p>Second &lt;part&gt;.</p><aside>side</aside><p>End.</p></article>
    <section id="comments"><p>I do not agree with any of this and say so at length.</p></section>
    <form><p>Your name</p></form><footer>&copy; somebody</footer></body></html>"""
    assert html.main_text(page) == "A & B First part goes on. Second <part>. End."


def test_page_without_marked_article():
    body = "".join(f"<p>Paragraph {i} with a fair number of words, so that its line is long.</p>" for i in range(6))
    page = f"<body><div class='menu'><a href='x'>one</a> <a href='y'>two</a></div><div>{body}</div><div id=footer>small print</div></body>"
    got = html.main_text(page)
    assert got.startswith("Paragraph 0") and got.endswith("its line is long.") and "small" not in got and "one" not in got


def test_surge_and_dive():
    assert html.regions([0, 0, 90, 0, 10, 0, 0, 0, 5, 0]) == [(2, 7, 100), (8, 10, 5)]
    assert html.regions([]) == []


def test_extract_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "plain words"), (4, "u", "plain words"),
            (None, "u", "<p>" + "long " * 100_000 + "</p>"), (5, "u", "<article><p>é &#233; &eacute;</article>")]
    got = Counter((r["page_id"], r["url"], r["text"][:20], r["n_chars"]) for r in html.extract(table(spark, rows)).collect())
    assert got == Counter([
        (1, "u", "", 0), (2, None, "", 0), (3, "u", "<p", 2), (4, "u", "plain words", 11), (4, "u", "plain words", 11),
        (None, "u", "long " * 4, 499_999), (5, "u", "é é é", 5)])
    assert html.extract(table(spark, rows).limit(0)).count() == 0


def test_archives_round_trip(spark):
    long = "<p>" + "x" * 200 + "</p>"
    rows = [(i, f"http://www.h{i % 3}.org/{i}", f"<p>{i}</p>" * (1 + i * 7)) for i in range(40)]
    rows += [(50, "u", long), (41, "http://a.org:80/Z?Q=1", long), (45, None, long), (46, "u\r\nv", "short"), (47, "u", "short"),
             (48, "u", None), (49, "u", ""), (51, "u", "a\r\n\r\nWARC/1.1\r\n" * 30), (None, "u", long), (52, "é", "é" * 60)]
    got = {r["page_id"]: r for r in warc.archive_round_trip(table(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, _, page in rows:
        payload = (page or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        again = page == long and i != 41
        assert (r["record_type"], r["refers_to"]) == (("revisit", 41) if again else ("response", None))
    assert warc.archive_round_trip(table(spark, rows).limit(0)).count() == 0


def test_index_is_in_global_order(spark):
    rows = [(i, f"http://h{i % 5}.org/p{i % 7}", f"page {i}") for i in random.Random(1).sample(range(3000), 1500)]
    merged = warc.archive_round_trip(table(spark, rows).repartition(6))
    parts = merged.rdd.mapPartitions(lambda it: [[(r["url_key"], r["capture_time"], r["page_id"]) for r in it]]).collect()
    keys = [k for part in parts for k in part]
    assert len(keys) == 1500 and keys == sorted(keys)


def test_any_long_is_a_page_id(spark):
    ids = [10**15, 10**12, -5, 0, 7, -(2**63), 2**63 - 1, None, None]
    merged = warc.archive_round_trip(table(spark, [(i, "http://a.org/", f"page {i}") for i in ids]))
    rows = merged.collect()
    assert Counter(r["page_id"] for r in rows) == Counter(ids)
    assert all(len(r["capture_time"]) == 20 for r in rows)
    keys = [(r["capture_time"], r["page_id"] is not None, r["page_id"] or 0) for r in rows]
    assert keys == sorted(keys)


def test_pieces_of_runs_are_merged_without_sorting():
    def entry(i):
        return (i, "u", "u", "t", 0, "", "response", None)

    tagged = [("a", entry(i)) for i in (1, 4, 4, 9)] + [("b", entry(i)) for i in (None, 2, 3)]
    tagged += [("a", entry(i)) for i in (0, 5)] + [("b", entry(8))]
    pieces = warc.sorted_pieces(iter(tagged))
    assert [[e[0] for e in p] for p in pieces] == [[1, 4, 4, 9], [None, 2, 3, 8], [0, 5]]
    assert [e[0] for e in warc.LoserTree(pieces, warc.order_of)] == [None, 0, 1, 2, 3, 4, 4, 5, 8, 9]


def test_records_cut_short_are_an_error():
    whole = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.records(io.BytesIO(whole * 2))] == [b"abc", b"abc"]
    for broken in (whole[:-5], whole[:-1], b"x" + whole):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(broken)))


def test_loser_tree():
    rng = random.Random(5)
    for k in range(1, 12):
        runs = [sorted(rng.choices(range(50), k=rng.randrange(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("http://www.Example.org:8080/A?b=C") == "org,example)/a?b=c"
    assert warc.url_key(None) == ")/" and warc.url_key("http://[bad") == ")http://[bad"


def test_unmarked_article_keeps_short_parts():
    body = "Words of the middle paragraph. " * 10
    page = (f"<div><h1>Title</h1><div class=share>tell others</div><p>{body}</p><div class=ad>buy</div><p>Short end.</p></div>")
    assert html.main_text(page) == f"Title {body.strip()} Short end."
    links = "<ul>" + "<li><a href=x>somewhere</a>" * 4 + "</ul>"
    page = f"<div><p>{body}</p>{links}<p>Short middle.</p>{links}<p>{body}</p></div>"
    assert html.main_text(page).count("middle") == 21 and "Short middle." in html.main_text(page)


def test_wrapper_of_an_article_is_not_skipped():
    side = "<div class=related><p>Something else to read, in a sentence of some length.</p></div>"
    for start, end in (("<div class='layout with-sidebar'>", "</div>"), ("<form>", "</form>"), ("<main><div id=has-comments>", "</div></main>")):
        assert html.main_text(f"<body>{start}{side}<article><p>Its text.</p></article>{end}</body>") == "Its text."
    page = "<article><p>Its text.</p><aside><article>A card.</article></aside></article><div class=comments><article>I disagree.</article></div>"
    assert html.main_text(page) == "Its text."


def test_links_of_a_marked_article_stay():
    page = "<article><h1><a href=x>Title</a></h1><p>Its text.</p><p><a href=y>Its source</a></p></article>"
    assert html.main_text(page) == "Title Its text. Its source"
    assert html.main_text("<main><a href=x>Only a link</a></main>") == "Only a link"


def test_unclosed_elements_take_linear_time():
    starts = ("<div class=ad>x ", "<label>x ", '<span class="share">x ', "<p class=ad>x ", "<li class=ad>x<ul>", "</div><section class=ad>",
              "<article class=x>y ", "<head>", "<!", "<!--", '<b "', "<b '\"", "<script x=", "<a href=x>y ")
    began = time.monotonic()
    for start in starts:
        html.main_text(start * 100_000)
    assert time.monotonic() - began < 2 * len(starts)
    assert html.main_text("<div class=ad>x " * 3) == "x x x"


def test_words_of_an_article_stay():
    page = ("<article><p class=legal>The law.</p><p class=reply>Its answer.</p><p class=search>We looked.</p><div class=tags>Red</div>"
            "<p>Take <label>this</label> now.</p><header class=header><h2>Part two</h2></header><p class=notice>A notice.</p>"
            "<div class=ad>buy</div><div class=comments>I disagree.</div><form><label>Name</label></form><nav>menu</nav></article>")
    assert html.main_text(page) == "The law. Its answer. We looked. Red Take this now. Part two"


def test_ends_of_elements():
    page = "<div><p class=ad>one<p>two</div><ul><li class=ad>a<ul><li>b</ul>c<li>d</ul><b class=ad><i>x</b></i></section><section>"
    tags = list(html._TAG.finditer(page))
    ends = html.element_ends(tags)
    shown = [page[t.start():e] for t, e in zip(tags, ends, strict=True) if not t[1]]
    assert shown == ["<div><p class=ad>one<p>two</div>", "<p class=ad>one", "<p>two", page[page.index("<ul>"):page.index("<b ")],
                     "<li class=ad>a<ul><li>b</ul>c", "<ul><li>b</ul>", "<li>b", "<li>d", "<b class=ad><i>x</b>", "<i>x</b></i>", "<section>"]


def slow_windows(sizes):
    """Lines under a window that holds text, by looking at every window anew."""
    covered = [any(sizes[j] for j in range(max(0, i - html.BLOCK + 1), i + 1)) for i in range(len(sizes))]
    found = []
    for i, c in enumerate(covered):
        if c and (not i or not covered[i - 1]):
            last = next((j for j in range(i, len(covered)) if not covered[j]), len(covered))
            found.append((i, last, max(sum(sizes[max(0, j - html.BLOCK + 1):j + 1]) for j in range(i, last))))
    return found


def test_windows_against_brute_force():
    rng = random.Random(8)
    for _ in range(500):
        sizes = [rng.choice((0, 0, 0, 5, 40, 200)) for _ in range(rng.randrange(0, 40))]
        assert html.regions(sizes) == slow_windows(sizes)


BESIDE = ("<nav><ul><li><a href=x>{}</a><li>{}</ul></nav>", "<div class=ad><div><p>{}</div>{}</div>", "<!-- {} --><script>'</p>{}'</script>",
          "<aside><p>{}<p>{}</aside>", "<form><p>{} <input value='{}'></form>", "<section id=comments><article><p>{}</article>{}</section>",
          "<footer>{}<div>{}</div></footer>", "<div style='display: none'>{} {}</div>", "<style>{}{}</style>")
BLOCKS = ("<p>{}</p>", "<p>{}", "<h2>{}</h2>", "<div><b>{}</b></div>", "<ul><li>{}</ul>", "<blockquote><p><i>{}</i></blockquote>",
          "<table><tr><td>{}</table>", "<div><section><p>{}</section></div>")


def made_page(rng, wrapper):
    """A page of nested blocks and unwanted elements, and the text its making gives it."""
    def words(n):
        return " ".join(rng.choice(("alpha", "b&amp;c", "&lt;d&gt;", "é", "f\n  g")) for _ in range(n))

    body, text = [], []
    for _ in range(rng.randrange(1, 12)):
        if rng.random() < 0.4:
            body.append(rng.choice(BESIDE).format(words(rng.randrange(1, 40)), words(3)))
        else:
            said = words(rng.randrange(20, 60))
            body.append(rng.choice(BLOCKS).format(said))
            text.append(said)
    around = [rng.choice(BESIDE).format(words(30), words(3)) for _ in range(4)]
    page = f"<html><head><title>{words(9)}</title></head><body>{around[0]}{around[1]}{wrapper[0]}{''.join(body)}{wrapper[1]}{around[2]}{around[3]}"
    plain = " ".join(text).replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")
    return page, " ".join(plain.split())


def test_made_pages():
    rng = random.Random(21)
    for _ in range(400):
        for wrapper in (("<article>", "</article>"), ("<div class='layout with-sidebar'><main>", "</main></div>"), ("<div>", "</div>")):
            page, text = made_page(rng, wrapper)
            comments = "<section id=comments><article>" in page
            if wrapper[0] == "<div>" and comments:
                page = page.replace("<article>", "<div>").replace("</article>", "</div>")
            assert html.main_text(page) == text, page


def test_markers_do_not_decide_on_the_given_pages(spark):
    """The windows alone give the same texts as with article tags."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    for (page,) in pages:
        bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert "<article>" in page and html.main_text(bare) == html.main_text(page)
