from folioforge.llm.htmltree import TreeModel, extract, labelled_pages, parse

MODEL = TreeModel(labelled_pages())

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/x>Menu</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy now.</div><article><h1>The   title &amp; more</h1><p><b>First&nbsp;part<br>of it.<p>Second 1 < 2 &eacute;&#x1F389; part that is rather long and says a lot of things to read.</p></article>
<aside class="sidebar"><h3>Related</h3><div><li><a href=/y>Other</a></li></div></aside><section class="comments"><div class="comment"><p>I disagree with all of this, dear author.</p></div></section><form class="search"><label>Find</label><input></form>
<footer>&copy; me</footer>"""


def test_page():
    assert MODEL.extract(PAGE) == "The title & more\n\nFirst part of it.\n\nSecond 1 < 2 é🎉 part that is rather long and says a lot of things to read."


def test_held_out_pages():
    right = total = 0
    for page in labelled_pages(150, seed=77):
        nodes, blocks = parse(page)
        belief = MODEL.marginals(nodes)
        inherited = []
        for e in nodes:
            inherited.append(e.label if e.label is not None else inherited[e.parent] if e.parent >= 0 else 0)
        total += len(blocks)
        right += sum((belief[k] >= 0.5) == bool(inherited[k]) for k, _ in blocks)
    assert right / total > 0.97


TEXT = "The river rose in the night, and by morning the lower fields were gone. Nobody had seen it come so fast. The miller opened all the gates he had."
MORE = "Three days later the water fell again. What it left behind was mud, and a boat that belonged to no one in the village."
TITLE = "A flood in the valley"
NAV = '<a href="/">Home</a> <a href="/news">News</a> <a href="/contact">Contact</a>'
#: Written by hand, of shapes that the generator does not make as such: page, main blocks, other blocks.
HAND = {
    "linked sentences": (f'<html><body><nav>{NAV}</nav><main><h1>{TITLE}</h1><p><a href="/1">{TEXT}</a></p><p><a href="/2">{MORE}</a></p></main></body></html>', [TITLE, TEXT, MORE], ["Home"]),
    "misleading class": (f'<body><div class="top-menu"><ul><li><a href=/>Home</a><li><a href=/b>Bread</a></ul></div><div class="cookie-recipe post"><h2>{TITLE}</h2><p>{TEXT}</p><p>{MORE}</p></div><div class="cookie-banner"><p>We use cookies to make this site better.</p></div></body>', [TITLE, TEXT, MORE], ["Bread", "We use cookies"]),
    "bare short blocks": ("<body><div>The boat was green.</div><div>Nobody claimed it.</div><div>It lay there until spring.</div><div>Then it was gone.</div><div>&copy; 2020 Valley Post. All rights reserved.</div></body>", ["The boat was green.", "Nobody claimed it.", "It lay there until spring.", "Then it was gone."], ["rights reserved"]),
    "layout table": (f'<body><table width=100%><tr><td width=150><p><a href=/>Home</a></p><p><a href=/n>News</a></p><p><a href=/c>Contact</a></p></td><td><h1>{TITLE}</h1><p>{TEXT}</p><p>{MORE}</p></td></tr></table></body>', [TITLE, TEXT, MORE], ["Contact"]),
    "blog": (f'<body><header class="masthead"><a href="/">My blog</a></header><div id="wrapper"><div id="content"><article class="hentry"><header><h1>{TITLE}</h1></header><div class="entry"><p>{TEXT}</p><blockquote>{MORE}</blockquote></div></article><div id="comments"><h3>2 replies</h3><ol><li class="comment"><p>I was there and it was worse than you say, believe me.</p></li></ol></div></div><div id="sidebar"><h4>Archive</h4><ul><li><a href=/1>May</a></li></ul></div></div><footer>Powered by paper</footer></body>', [TITLE, TEXT, MORE], ["I was there", "Archive", "May", "Powered"]),
    "sections": (f'<body><div role="navigation">{NAV}</div><div role="main"><section><h2>{TITLE}</h2><p>{TEXT}</p></section><section><ul><li>{MORE}</li><li>Second point, which is that mud is heavy.</li></ul></section></div><aside><p>Buy boots at the best price in town.</p></aside></body>', [TITLE, TEXT, MORE, "Second point, which is that mud is heavy."], ["Contact", "Buy boots"]),
    "newspaper": (f'<body><div class="ad-slot">Advertisement</div><div class="story-body"><p class="lead">{TEXT}</p><div class="advert"><p>Sponsored: boots, half price.</p></div><p>{MORE}</p><table><tr><td>Height</td><td>4 m</td></tr></table></div><div class="related"><h3>Related</h3><a href=/q>Older floods</a></div><form class="newsletter"><p>Sign up for the newsletter.</p><input><button>Go</button></form></body>', [TEXT, MORE, "Height", "4 m"], ["Advertisement", "Sponsored", "Older floods", "Sign up"]),
    "plain": (f"<html><body><h1>{TITLE}</h1>{TEXT}<p>{MORE}</body></html>", [TITLE, TEXT, MORE], []),
}


def test_hand_written_pages():
    """Precision and recall over blocks of pages that were written and marked by hand."""
    kept = wanted = wrong = 0
    for name, (page, main, rest) in HAND.items():
        blocks = MODEL.extract(page).split("\n\n")
        good = [b for b in blocks if b in main]
        kept, wanted, wrong = kept + len(good), wanted + len(main), wrong + len(blocks) - len(good)
        assert not any(r in b for r in rest for b in blocks), (name, blocks)
        assert blocks == main, (name, blocks)
    assert kept == wanted and not wrong


def test_tables_of_pages(spark, sf):
    """The driver's pages hold their text in an article: all of it is kept, and nothing else."""
    import re

    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in extract(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for r in rows:
        article = re.search(r"<article>.*</article>", r["html"], re.S)[0]
        nodes, blocks = parse(article)
        assert got[r["page_id"]] == "\n\n".join(t for _, t in blocks), r["page_id"]


def test_broken_and_extreme(spark):
    deep = "<div>" * 5000 + "text in the deep " * 20
    rows = [(1, "u", None), (2, None, ""), (3, "u", "just words, no tags at all"), (4, "u", "<<<>>></p></div><p"), (5, "u", deep), (6, "u", "<!-- never ends <p>x"), (7, "u", "<article>" + "<p>long enough words here to read</p>" * 5000), (7, "u", "x"), (None, "u", PAGE)]
    got = extract(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got if r["page_id"] != 7}
    assert by[1] == by[2] == by[6] == "" and by[None] == MODEL.extract(PAGE)
    assert max(r["n_chars"] for r in got if r["page_id"] == 7) == 5000 * len("long enough words here to read") + 4999 * 2
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_hostile_pages_take_linear_time():
    """A megabyte of nested, stray, never closed and never quoted tags."""
    import time

    pages = ["<div>" * 200_000, "<div>" * 60_000 + "</span>" * 100_000, '<a "' * 250_000, '<a ">' * 200_000, "<ul><li>" * 60_000 + "</b>" * 100_000, "<b>" * 150_000 + "<p>" * 150_000, "<a" * 400_000, "<!--" * 250_000]
    for page in pages:
        began = time.time()
        parse(page)
        parse(page + "words")
        assert time.time() - began < 20, page[:10]  # two to four seconds on one core; the square of the length would be hours
    assert MODEL.extract("<div>" * 100_000 + PAGE) == MODEL.extract(PAGE)
