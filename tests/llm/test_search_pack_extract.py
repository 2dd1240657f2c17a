"""Top-k search, packing and extraction against brute force, and their defined cases."""

import html as entities
import random
import re
from collections import namedtuple

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import extraction, packing, topk
from tidemark.llm.common import read

SF = "/root/testdata/sf0.001"


# --------------------------------------------------------------------------------- search

def brute_topk(rows, k):
    usable = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in usable if i % 100 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for i, v in usable if i == q
                      for j, w in usable if j != q and len(w) == len(v))[:k]
        out |= {(q, rank, j, -s) for rank, (s, j) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("k", [1, 10])
def test_topk_equals_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 64]) for i in range(0, 900, 5)]  # many ties
    rows += [(7, None), (14, [1.0, None, 0.0, 0.0]), (21, [float("nan")] * 4), (28, [float("inf")] * 4), (None, [1.0] * 4),
             (1000, [0.5, 0.5]), (1001, [0.25, -0.5]), (1100, []), (1200, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, shard int, rank int")
    out = topk.search(docs, F.col("vec_id") % 100 == 0, k).collect()
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in out]
    assert len(got) == len(set(got)) and {g for g in got if g[0] != 1100} == brute_topk(rows, k)


def test_topk_repeated_rows_large_values_and_empty(spark):
    big = 2.0 ** 40
    rows = [(100, [big, 1.0]), (1, [big, 1.0]), (2, [big, 2.0]), (2, [big, 2.0]), (3, [-big, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert int(2.0 ** 100) > 2 ** 63  # products of these do not fit a long: such data is out of range
    small = docs.select("vec_id", F.transform("embedding", lambda x: x / 2 ** 20).alias("embedding"))
    out = topk.search(small, F.col("vec_id") % 100 == 0, 10).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [1, 2, 2, 3]
    exact = lambda v: [int(np.floor(1024 * x / 2 ** 20)) for x in v]
    assert out[0].score == sum(a * a for a in exact([big, 1.0]))
    assert topk.search(docs.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_topk_of_many_blocks_against_large_shards(spark, monkeypatch):
    """A shard is 8 MB here: sent once for each of 400 blocks, it filled one Arrow batch with 3 GB and the job failed."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 1)
    ids, whole = np.arange(2000), np.random.default_rng(2).integers(-30, 31, (2000, 2000))
    arrays = pa.ListArray.from_arrays(pa.array(np.arange(0, whole.size + 1, 2000), pa.int32()),
                                      pa.array((whole / 1024).astype("f4").reshape(-1)))
    docs = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": arrays}))
    out = topk.search(docs, F.col("vec_id") % 5 == 0, 2).collect()
    scores = whole[::5] @ whole.T
    scores[np.arange(400), ids[::5]] = -10 ** 9
    want = {(5 * q, rank, int(v), int(scores[q, v])) for q in range(400)
            for rank, v in enumerate(np.lexsort((ids, -scores[q]))[:2], 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in out} == want and len(out) == 800


@pytest.mark.parametrize("scale", [1, 2 ** 20, 2 ** 27])  # float32, float64 and Python integers
@pytest.mark.parametrize("kinds", [2, 3000])  # nearly all scores tied, or few
def test_topk_lists_over_shards_equal_brute_force(scale, kinds, monkeypatch):
    monkeypatch.setattr(topk, "PIECE", (3, 7))
    rng = np.random.default_rng(kinds)
    pool = rng.integers(-9, 10, (kinds, 3)).astype("f8") * scale
    ids, data = rng.integers(0, 150, 300), pool[rng.integers(0, kinds, 300)]  # ids come again
    asked = np.sort(rng.choice(150, 20, replace=False))
    q_ids, q_data = np.r_[asked, asked[:5]], pool[rng.integers(0, kinds, 25)]
    order = np.argsort(q_ids, kind="stable")
    lists = topk.Lists(q_ids[order], q_data[order], 4, 8)
    for s in range(0, 300, 45):
        lists.meet(ids[s:s + 45], data[s:s + 45])
    got = sorted(zip(*(x.tolist() for x in topk.best(*lists.entries(), 4)), strict=True))
    want = []
    for q in asked:
        pairs = [(-sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), int(i))
                 for j, x in zip(q_ids, q_data, strict=True) if j == q for i, y in zip(ids, data, strict=True) if i != q]
        want += [(int(q), rank, i, -score) for rank, (score, i) in enumerate(sorted(pairs)[:4], 1)]
    assert got == want


def test_topk_scores_out_of_range_are_no_wrong_scores():
    ids, big = np.arange(4), 2.0 ** 60
    lists = topk.Lists(np.array([9]), np.array([[big, 1.0]]), 2, 8)
    lists.meet(ids, np.array([[-big, 0.0], [-1.0, 2.0], [2.0, 3.0], [1.0, 3.0]]))  # the first is below every long
    query, rank, vec, score = topk.best(*lists.entries(), 2)
    assert vec.tolist() == [2, 3] and score.tolist() == [2 ** 61 + 3, 2 ** 60 + 3]
    with pytest.raises(OverflowError):
        lists.meet(ids, np.full((4, 2), big))
    lone = topk.Lists(np.array([9]), np.array([[big, 1.0]]), 2, 8)
    lone.meet(ids[:1], np.array([[-big, 0.0]]))
    columns = dict(zip(("query_ids", "vec_ids", "scores"), (pa.array([x.tobytes()]) for x in lone.entries()), strict=True))
    with pytest.raises(OverflowError):
        topk._merged(2)(pa.table(columns))


def test_topk_portions_hold_bounded_bytes(monkeypatch):
    Block = namedtuple("Block", "block dim asked")
    blocks = [Block(b, 64, 1000) for b in (30, 0, 7, 8, 9)]
    each = 1000 * (8 * 64 + 16 * 10 + 8)
    monkeypatch.setattr(topk, "PORTION_BYTES", 2 * each)
    assert topk.portions(blocks, 10) == [(0, 7), (8, 9), (30, 30)]
    monkeypatch.setattr(topk, "PORTION_BYTES", 1)
    assert [a for a, z in topk.portions(blocks, 10) if a == z] == [0, 7, 8, 9, 30]


@pytest.mark.parametrize("portion", [1, 1 << 26])
def test_topk_hot_ids_lengths_and_element_types(spark, portion, monkeypatch):
    """Half the rows share an id that is also asked for; several portions give the same as one."""
    monkeypatch.setattr(topk, "PORTION_BYTES", portion)
    monkeypatch.setattr(topk, "SHARD_ROWS", 8)
    rng = random.Random(5)
    rows = [(100 if i % 2 else i, [rng.randrange(-3, 4) for _ in range(2 + i % 3)]) for i in range(120)]
    rows += [(200, None), (300, [1, None])]
    docs = spark.createDataFrame(rows, "vec_id int, embedding array<int>").repartition(2)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(docs, F.col("vec_id") % 50 == 0, 3).collect())
    whole, want = [(i, [1024 * x for x in v]) for i, v in rows if v and None not in v], []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        pairs = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j) for i, x in whole if i == q
                       for j, y in whole if j != q and len(x) == len(y))
        want += [(q, rank, j, -score) for rank, (score, j) in enumerate(pairs[:3], 1)]
    assert got == want


# -------------------------------------------------------------------------------- packing

def check_packing(lengths, out, capacities):
    pieces, bins = {}, {}
    for r in out:
        pieces.setdefault(r.doc_id, []).append((r.first, r.length))
        bins.setdefault(r.bin_id, []).append(r)
    for doc, length in lengths:
        at = 0
        for first, size in sorted(pieces[doc]):
            assert first == at and 0 < size <= max(capacities)
            at += size
        assert at == length
    for rows in bins.values():
        rows.sort(key=lambda r: r.bin_first)
        assert [r.bin_first for r in rows] == np.cumsum([0, *[r.length for r in rows][:-1]]).tolist()
        used = sum(r.length for r in rows)
        cheapest = min((c for c in capacities if c >= used), key=lambda c: (packing.cost(c), c))
        assert {(r.bin_used, r.capacity) for r in rows} == {(used, cheapest)}
    return sum(packing.cost(rows[0].capacity) for rows in bins.values())


def test_packing_is_complete_and_close_to_the_bound(spark):
    rng = random.Random(1)
    lengths = [(i, rng.choice([1, 3, 20, 100, 255, 256, 257, 900, 5000, 8192, 8193, 20_000])) for i in range(800)]
    docs = spark.createDataFrame([(*x, 1) for x in lengths], "doc_id long, length long, capacity int")
    out = packing.pack(docs).collect()
    price = check_packing(lengths, out, packing.CAPACITIES)
    # no packing costs less than each piece's share of the cheapest full bin that it fits into
    bound = sum(r.length * min(packing.cost(c) / c for c in packing.CAPACITIES if c >= r.length) for r in out)
    assert bound <= price <= 1.1 * bound


def test_several_capacities_cost_no_more_than_one(spark):
    rng = random.Random(3)
    lengths = [(i, max(1, int(rng.lognormvariate(5, 1.2)))) for i in range(600)]
    docs = spark.createDataFrame(lengths, "doc_id long, length long")
    several = check_packing(lengths, packing.pack(docs).collect(), packing.CAPACITIES)
    single = check_packing(lengths, packing.pack(docs, (8192,)).collect(), (8192,))
    assert several <= single


def test_best_fit_takes_the_fullest_bin():
    packer = packing.Packer(np.array([60, 50, 40, 30, 10]), (100,), float)
    assert [packer.place(i) for i in range(5)] == [0, 1, 0, 1, 1]
    assert packer.used == [100, 90]


def test_opening_looks_at_what_can_still_join():
    assert packing.Packer(np.array([100]), (128, 1024), float).opened(0) == 128  # nothing else to hold
    many = packing.Packer(np.array([100] * 50), (128, 1024), float)
    assert many.opened(0) == 1024  # filled by ten, 1024 slots waste less than 128 with one


def test_packing_defined_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a b")], "doc_id long, text string")
    lengths = docs.select("doc_id", packing.length_in_words(F.col("text")).alias("length"))
    assert sorted(r.length for r in lengths.collect()) == [1, 1, 1, 3]
    out = packing.pack(lengths).collect()
    assert len(out) == 4 and {r.capacity for r in out} == {256}
    assert packing.pack(lengths.limit(0)).collect() == []


# ----------------------------------------------------------------------------- extraction

def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("cells", [1, 50, 4_000_000])
def test_common_is_a_longest_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(extraction, "TABLE_CELLS", cells)
    rng = np.random.default_rng(cells)
    for _ in range(150):
        a, b = (rng.integers(0, rng.integers(1, 9), rng.integers(0, 25)).astype(np.uint64) for _ in range(2))
        in_a, in_b = extraction.common(a, b)
        assert a[in_a].tolist() == b[in_b].tolist() and in_a.sum() == brute_lcs(a.tolist(), b.tolist())


def article(html):
    """The article of the test pages, by their fixed layout."""
    inside = html[html.find("<article>") + 9:]
    inside = inside[:inside.find("</article>")] if "</article>" in inside else inside
    parts = [" ".join(entities.unescape(re.sub("</?b>", "", x)).split()) for x in re.split("</?(?:p|h1|br)>", inside)]
    return "\n".join(p for p in parts if p)


def test_extraction_of_the_test_pages(spark):
    pages = read(spark, SF, "pages")
    out = {r.page_id: r for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        assert out[r.page_id].text == article(r.html) and out[r.page_id].n_chars == len(article(r.html))


def test_pages_without_articles_lose_what_neighbours_share(spark):
    page = "<body><div>Site name</div><div>Home</div><p>{}</p><div>Imprint of the site</div></body>"
    rows = [(1, "http://h.org/a/1", page.format("first own words")), (2, "http://H.org/a/2?x=1", page.format("second &amp; own")),
            (3, "https://h.org/a/3#top", page.format("third")), (4, "http://other.org/a", page.format("alone"))]
    docs = spark.createDataFrame([(*r, "clash", "k") for r in rows], "page_id long, url string, html string, text string, key string")
    got = {r.page_id: r.text for r in extraction.extract(docs).collect()}
    assert got == {1: "first own words", 2: "second & own", 3: "third",
                   4: "Site name\nHome\nalone\nImprint of the site"}


def test_template_lines_inside_articles_go_and_copied_passages_stay(spark):
    page = "<article><h1>Title {0}</h1><p>Words of {0}.</p>{1}<p>More of {0}.</p><p>All rights with the paper</p></article>"
    passage = "<p>A passage that some pages quote</p>"
    rows = [(i, f"http://h.org/{i}", page.format(i, "")) for i in range(10, 18)]
    rows += [(i, f"http://h.org/{i}", page.format(i, passage)) for i in (20, 21, 22)]
    rows += [(i, f"http://copies.org/{i}", page.format(7, "")) for i in range(30, 38)]  # copies of one page keep their text
    rows += [(i, f"http://few.org/{i}", page.format(i, "")) for i in range(40, 43)]  # too few to tell
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in extraction.extract(docs).collect()}
    last = "All rights with the paper"
    for i in range(10, 18):
        assert got[i] == [f"Title {i}", f"Words of {i}.", f"More of {i}."]
    for i in (20, 21, 22):
        assert got[i] == [f"Title {i}", f"Words of {i}.", "A passage that some pages quote", f"More of {i}."]
    assert all(got[i] == ["Title 7", "Words of 7.", "More of 7.", last] for i in range(30, 38))
    assert all(got[i][-1] == last for i in range(40, 43))


def test_body_around_a_teaser_stays_and_shared_lines_around_it_go(spark):
    page = ("<body><div>Site name</div><article><p>Teaser {0}</p></article><div>The long body of page {0} stands out here</div>"
            "<div>Imprint of the site</div></body>")
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in (1, 2, 3)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(docs).collect()}
    assert got == {i: f"Teaser {i}\nThe long body of page {i} stands out here" for i in (1, 2, 3)}


def test_furniture_is_not_text(spark):
    source = """<html><head><title>t</title><style>p{}</style></head><body><header>H</header><nav><a>N</a></nav>
      <div class="cookie-banner">C</div><main><h1>Head&shy;</h1><script>var x="</p>";</script><p>One  <b>two</b>&nbsp;three
      <p>four<br>five<aside>S</aside><form><input>F</form><div id="comments"><p>R</p></div><div style="display: none">Z</div>
      a &lt; b &amp b &am</main><div class="ad">A</div><footer>F</footer></body>"""
    text = "\n".join(extraction.main_blocks(source, None))
    assert text == "Head\xad\nOne two three\nfour\nfive\na < b & b &am"


@pytest.mark.parametrize("attributes, stays", [
    ('class="overflow-hidden"', True), ('data-title="hidden places"', True), ("data-class='menu'", True), ('id="x"', True),
    ("hidden", False), ('id="x" hidden', False), ('HIDDEN=""', False), ('aria-hidden="true"', False), ("aria-hidden=true", False),
    ('aria-hidden="false"', True), ('style="color:red; display : none"', False), ('title="display:none"', True),
    ('class="sidebar"', False), ("class=site-header", False)])
def test_only_attributes_that_say_so_hide_an_element(attributes, stays):
    assert extraction.main_blocks(f"<div {attributes}><article><p>Text</p></article></div>", None) == ["Text"] * stays


def test_names_inside_an_article_remove_only_what_is_foreign():
    page = "<{0}><div class='{1}'><h1>Title</h1></div><p>Text</p></{0}>"
    for name in ("entry-header", "masthead", "widget text", "related-work", "notice", "menu"):
        assert extraction.main_blocks(page.format("article", name), None) == ["Title", "Text"]
    for name in ("ad", "post-comments", "share", "newsletter"):
        assert extraction.main_blocks(page.format("article", name), None) == ["Text"]
    assert extraction.main_blocks(page.format("main", "entry-header"), None) == ["Title", "Text"]
    assert extraction.main_blocks(page.format("main", "sidebar"), None) == ["Text"]


def test_extraction_defined_cases(spark):
    rows = [(1, "http://h/x", None), (2, None, "<p>a"), (2, None, "<p>a"), (None, "http://h/x", ""), (3, "no url", "plain < text <"),
            (4, "http://h/y", "<p>" + "w " * 100_000), (5, "http://h/y", "<article><p>cut <b>off"), (6, "", "<!-- open"), (6, "x", "<p title='")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id or -1, r.text, r.n_chars) for r in extraction.extract(docs).collect())
    assert got == sorted([(1, "", 0), (2, "a", 1), (2, "a", 1), (-1, "", 0), (3, "plain < text <", 14),
                          (4, ("w " * 100_000).strip(), 199_999), (5, "cut off", 7), (6, "", 0), (6, "", 0)])
    assert extraction.extract(docs.limit(0)).collect() == []
