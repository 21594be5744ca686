"""Cases in which an operator once did less than the whole job."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann_forest, html_text, mixing, packing, quality


@pytest.mark.parametrize("n", [4_000, 60_000])
def test_forest_recall_as_the_query_runs(spark, tmp_dir, n):
    import pyarrow as pa
    import pyarrow.parquet as pq

    m = np.random.default_rng(n).normal(size=(n, 128)).astype(np.float32)
    for k in range(8):
        pq.write_table(pa.table({"vec_id": pa.array(np.arange(n)[k::8]), "embedding": pa.array(list(m[k::8]), pa.list_(pa.float32()))}), f"{tmp_dir}/{k}.parquet")
    got = defaultdict(set)
    for r in ann_forest.nearest(spark.read.parquet(tmp_dir), F.col("vec_id") % 300 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    met = 0
    for q in range(0, n, 300):
        s = u @ u[q]
        s[q] = -9
        met += len(got[q].intersection(np.argsort(-s)[:5].tolist()))
    assert met / (5 * len(range(0, n, 300))) >= 0.9


def test_a_small_language_is_not_judged_by_the_others(spark):
    r = np.random.default_rng(3)
    latin = ["time", "house", "people", "water", "garden", "morning", "between", "another", "river", "letter", "window", "country"]
    thai = ["".join(chr(c) for c in r.integers(0xE01, 0xE2E, 6)) for _ in range(40)]
    rows = [(i, " ".join(f"{latin[a]}" for a in r.integers(0, 12, 120)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(thai[a] for a in r.integers(0, 40, 120)), "th") for i in range(20)]
    rows += [(2000, " ".join(thai[a] for a in r.integers(0, 40, 120)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: (x["base_failed"], x["kept"]) for x in quality.judged(quality.measured(docs)).collect()}
    assert not any(failed for failed, _ in got.values())
    assert [i for i, (_, kept) in got.items() if not kept] == [2000]


@pytest.mark.parametrize("part_pages", [1, 3, 2000])
def test_repeats_are_found_across_the_parts_of_a_host(spark, part_pages):
    shared = [" ".join(f"s{k}x{j}" for j in range(9)) for k in range(12)]
    rows = [(i, "http://h.org/x", [0, 0, 0], [f"own words of page {i}", shared[i // 2], f"end{i} of it"]) for i in range(24)]
    rows += [(None, "http://h.org/y", [0], [f"page without id {shared[0]}"]), (50, "http://other.org/", [0], [shared[0]])]
    table = spark.createDataFrame(rows, "page_id long, url string, roles array<tinyint>, texts array<string>")
    got = {r["page_id"]: r["text"] for r in html_text.unique_runs(table, part_pages=part_pages).collect()}
    assert got == {**{i: f"own words of page {i}\nend{i} of it" for i in range(24)}, None: "page without id", 50: shared[0]}


@pytest.mark.parametrize("page,kept", [
    ('<div class="content-sidebar-wrap"><main><p>real text</p></main><aside>x</aside></div>', ["real text"]),
    ('<div class="no-sidebar"><div id="with-nav"><article><p>real text</p></article></div></div>', ["real text"]),
    ('<div class="has-header"><p>about</p><article>real text<div class="share">tell</div></article></div>', ["real text"]),
    ('<div class="sidebar"><article>real text</article></div>', ["real text"]),
    ('<main>intro<div class="content-sidebar-wrap"><article>real text</article></div></main>', ["intro", "real text"]),
    ('<main>real text<div class="related"><article>teaser</article></div></main>', ["real text"]),
    ('<article>real text</article><div class="related posts"><article>teaser</article></div>', ["real text"]),
    ('<nav><article>menu</article></nav><article>real text</article>', ["real text"]),
    # within an article a name counts only if all its words name a part; other attributes and their texts never do
    ('<article><p data-id="share-3">a</p><p class="ad-hoc">b</p><section id="related-work">c</section></article>', ["a", "b", "c"]),
    ('<article><h2 id="social-history">a</h2><p title="see id=ad">b</p><p>c <span id="comment">d</span></p></article>', ["a", "b", "c d"]),
    ("<article><p data-x=it's>a</p><p>it's b</p><p title='c > d' class=x>e</p></article>", ["a", "it's b", "e"]),
    ('<article>a<div class="share-buttons">x</div><ul class="related-posts"><li>x</ul><div class=ad>x</div><div id="comments">x</div>b</article>', ["a", "b"]),
    ('<main><p>a</p><article class="comment"><p>reader</p></article><p>b</p></main>', ["a", "b"])])
def test_a_hint_does_not_drop_the_article_below_it(page, kept):
    assert [t for role, t in html_text.blocks(f"<html><body>{page}</body></html>") if role == html_text.KEEP] == kept


def test_broken_tags_do_not_take_the_text():
    for page, kept in (("<article>a < b <p>c</article>", ["a < b", "c"]), ("<article><p class='x>a</p>b</article>", ["a", "b"]),
                       ("<article>a</p></div>b</article", ["a", "b"]), ("<article>" + "<div a=b>" * 300 + "deep", ["deep"])):
        assert [t for _, t in html_text.blocks(page)] == kept
    assert html_text.blocks('<p x="a"' * 3000) == [] and html_text.blocks("") == []


def test_pieces_that_fill_nothing_do_not_end_in_one_shard(spark):
    rows = [(i, 0, 2100 + i * 37 % 1700, i) for i in range(640)]
    table = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long")
    got = packing.pack(table, shard_tokens=30_000).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(640)) and len({r["sequence_id"] for r in got}) == 640
    shards = defaultdict(int)
    for r in got:
        shards[r["sequence_id"] >> 34] += r["length"]
    assert max(shards.values()) <= 2 * 8 * 30_000


def test_multiples_of_one_vector_tie_and_smaller_ids_come_first(spark):
    base = [1.0, 2.0, -3.0, 0.5]
    rows = [(i, [x * (1 + i % 40) for x in base], 1) for i in range(0, 400)] + [(1000, [0.0, 0.0, 1.0, 0.0], 1), (1000, [0.0, 0.0, 1.0, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {}
    for r in ann_forest.nearest(table, F.col("vec_id") % 100 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    unit = np.array([x for _, x, _ in rows], np.float32).astype(float)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    for q in (0, 100, 200, 300):
        assert sorted(got[q]) == [(k + 1, v, 1.0) for k, v in enumerate([v for v in range(400) if v != q][:5])]
    assert len(got[1000]) == 5


def test_mixing_reaches_a_target_far_below_the_source(spark):
    """A source of many short texts beside one very long one, nearly all of the corpus: its rate is far out on the dual's axis."""
    rows = [(i, "a b", "x") for i in range(3000)] + [(5000, "w " * 40_000, "x"), (5001, "z " * 60, "y"), (5002, None, "y"), (5003, "z " * 70, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed_words(docs).collect()
    taken, target = {}, {}
    for r, (_, _, s) in zip(sorted(out, key=lambda r: r["doc_id"]), sorted(rows)):
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 130 for s in taken), (taken, target)
