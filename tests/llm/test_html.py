import re
import time
from collections import defaultdict

import pytest
from conftest import ORACLE_DIR

from strata.llm import html_suffix as H

SCHEMA = "page_id long, url string, html string"


def extracted(spark, rows, **options):
    return {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, SCHEMA), **options).collect()}


LONG = {
    "open quotes": "<p it's", "open tags": "<a ", "forms": "<form>a b</form>", "menus": "<nav><article>x", "bold": "<b></i>",
    "quoted signs": '<a "<b >" ', "scripts": "<script></script ", "comments": "<!-- ", "signs": "<",
}


@pytest.mark.parametrize("name", LONG)
def test_time_is_linear_in_the_page(name):
    def took(n):
        page = LONG[name] * (n // len(LONG[name]))
        begin = time.process_time()
        H.parse(page)
        return time.process_time() - begin

    quarter = max(0.05, took(1 << 17))
    assert took(1 << 19) < 12 * quarter  # 4 times the text; a square would be 16 times, from far above


def test_markup_of_all_kinds():
    text = lambda page: H.main_text(H.parse(page))
    assert text("<p title='a > b'>x</p>") == "x" and text('<p title="a > b>x</p>') == "b>x"
    assert text("a < b <3 c") == "a < b <3 c" and text("a<!-- <p>b</p> -->c<!-- d") == "ac"
    assert text("<p>a</b></i>b<p>c") == "ab\nc" and text("x<p a=1") == "x<p a=1"
    assert text("<script>a</script  >b<SCRIPT>c</sCript>d<style>e") == "bd"
    assert text("<?xml a?>x<!DOCTYPE b></ >y") == "xy"


def host_of(url):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"(?s).*?://([^/?#]*)", url or "")[1]) if "://" in (url or "") else ""


def brute(rows, structure):
    """What hosts repeat, by comparing the word sequences of all pages of a host."""
    pages = {}
    for i, url, html in rows:
        blocks = [(r if structure else H.OPEN, b) for r, b in H.parse(html)]
        pages[i] = (host_of(url), blocks, tuple(b for r, b in blocks if r != H.DROPPED) or tuple(b for _, b in blocks))
    out = {}
    for i, (host, blocks, _) in pages.items():
        others = {c: b for h, b, c in pages.values() if h == host and c}
        share = max(2, -(-len(others) // 5))
        has = lambda test: sum(any(test(b) for b in c) for c in others.values())
        free = lambda t: (lambda b: b[0] == H.OPEN and b[1] == t)
        whole = [k for k, (r, t) in enumerate(blocks) if r == H.OPEN and len(others) > 1 and has(free(t)) >= max(2, -(-len(others) // 5))]
        article = [k for k, (r, _) in enumerate(blocks) if r == H.ARTICLE]
        for places in (range(H.EDGE), range(-1, -H.EDGE - 1, -1)):
            for j in places:
                if -len(article) <= j < len(article):
                    t, n = blocks[article[j]][1], 0
                    for b in others.values():
                        own = [x for r, x in b if r == H.ARTICLE]
                        n += -len(own) <= j < len(own) and own[j] == t
                    if n >= max(3, len(others) // 2 + 1):
                        whole.append(article[j])
        seqs = defaultdict(set)
        for c, b in others.items():
            # Blocks that are boilerplate as a whole have no suffixes.
            for r, t in b:
                if r == H.OPEN and not (len(others) > 1 and has(free(t)) >= share):
                    w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split(" ")
                    for p in range(len(w) - H.RUN + 1):
                        seqs[tuple(w[p : p + H.RUN])].add(c)
        covered = []
        for k, (r, t) in enumerate(blocks):
            if r == H.OPEN and k not in whole:
                w = re.sub("[A-Z]", lambda m: m[0].lower(), t).split(" ")
                covered += [(k << 32) + p for p in range(len(w) - H.RUN + 1) if len(others) > 1 and len(seqs[tuple(w[p : p + H.RUN])]) >= share]
        out[i] = H.main_text(blocks, whole, covered)
    return out


@pytest.mark.parametrize("structure", [True, False])
def test_against_brute_force(spark, structure):
    rows = [tuple(r) for r in spark.read.parquet(f"{ORACLE_DIR}/pages.parquet").collect()]
    # Pages of one host without articles, which share blocks, parts of blocks and copies.
    word = lambda a, n: " ".join(f"{a}{k}" for k in range(n))
    for k in range(30):
        parts = [f"<div>{word('menu', 9)}</div>" * (k % 3 == 0), f"<div>{word(f'u{k}x', 12)} {word('quote', 10 + k % 4)} {word(f'v{k}x', 20 * (k % 2))}</div>"]
        parts += [f"<div>{word(f'own{k % 25}x', 9)}</div>", f"<article><h1>News</h1><p>{word(f'a{k}', 9)}</p><p>{word('sign', 5)}</p></article>" * (k > 12)]
        rows.append((10_000 + k, f"http://Host.example/{k}", "".join(parts)))
    assert extracted(spark, rows, structure=structure) == brute(rows, structure)


def test_articles_keep_what_other_pages_quote(spark):
    word = lambda a, n: " ".join(f"{a}{k}" for k in range(n))
    quote = word("q", 14)
    rows = [(k, f"http://h/{k}", f"<article><p>{word(f'w{k}x', 9)}</p><p>{quote}</p><p>{word(f'z{k}x', 9)}</p></article>" if k < 25 else f"<article><p>{word(f'w{k}x', 9)}</p></article>") for k in range(120)]
    got = extracted(spark, rows)
    assert all(quote in got[k] for k in range(25))


def test_no_article_line_of_the_tables_is_lost(spark):
    pages = spark.read.parquet(f"{ORACLE_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = [t for k, t in H.parse(r.html) if k == H.ARTICLE]
        assert got[r.page_id].split("\n") == article or not article
