"""Each operator against a brute-force version on a small table with nulls, empties, copies and clashing columns."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import (ann_forest, chat_trees, common, html_text, language_id, lm_scoring, mixing, near_dedup, packing, quality,
                         substring_dedup, tokens)

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, label string, value long"


def make_texts():
    r = random.Random(5)
    vocab = ["the", "Of", "and", "río", "straße", "x1", "0day", "a,", "b."] + [f"w{i}" for i in range(60)]
    base = [[r.choice(vocab) for _ in range(r.randrange(1, 160))] for _ in range(40)]
    passage = [r.choice(vocab) for _ in range(70)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:  # near copies
        c = list(b)
        c[r.randrange(len(c))] = "changed"
        texts.append("\n".join(c))
    texts += texts[:5]  # exact copies
    texts += [" ".join(b[:20] + passage + b[20:]) for b in base[20:26]]  # a shared passage
    texts += [None, "", " \t\n", "one", "two words", "long " * 9000, "<|endoftext|> 007  z"]
    return texts


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2", "s3"][i % 4], len(t or ""), 1, "x", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(t):
    return (t or "").encode().split()


def rows(df):
    return [r.asDict() for r in df.collect()]


def components(texts, n, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, n, percent):
    expected = components(texts, n, percent)
    got = {r["doc_id"]: r for r in rows(near_dedup.near_duplicates(docs, n, percent))}
    assert {i: (g["n_shingles"], g["component_id"], g["kept"]) for i, g in got.items()} == {
        i: (s, c, c == i) for i, (s, c) in enumerate(expected)}


def test_near_duplicates_in_block_pairs(docs, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "LIST_ROWS", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 100)
    expected = components(texts, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in rows(near_dedup.near_duplicates(docs, 3, 85))} == {i: c for i, (_, c) in enumerate(expected)}


def test_near_duplicates_edges(spark, docs, empty):
    assert near_dedup.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in rows(near_dedup.near_duplicates(odd))), key=str)
    assert got == sorted([(None, None, True), (1, 1, True), (1, 1, True), (2, 2, True)], key=str)
    assert near_dedup.drop_near_duplicates(docs).columns == docs.columns


def repeats(texts, window=50):
    seen, out = {}, []
    for i, t in enumerate(texts):
        w = words(t)
        off = [False] * len(w)
        new = []
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if seen.get(key, i) < i:
                off[k:k + window] = [True] * window
            new.append(key)
        for key in new:
            seen.setdefault(key, i)
        kept = [x for x, o in zip(w, off) if not o]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substring_dedup(docs, texts, empty):
    expected = repeats(texts)
    assert sum(e[1] for e in expected) > 300
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows(substring_dedup.digest(docs, substring_dedup.factors(docs)))}
    assert got == dict(enumerate(expected))
    cut = {r["doc_id"]: r["text"] for r in rows(substring_dedup.remove_repeats(docs))}
    for i, (n, gone, sha) in enumerate(expected):
        if gone == n and n:
            assert i not in cut
        else:
            assert hashlib.sha256(b" ".join(words(cut[i]))).hexdigest() == sha
    assert substring_dedup.factors(empty).count() == 0


def test_two_texts_of_one_doc_id_are_judged_apart(spark):
    w, u = " ".join(f"w{i}" for i in range(80)), " ".join(f"u{i}" for i in range(80))
    rows_ = [(1, w), (1, w), (2, w), (2, u), (3, u + " x"), (None, w), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, *[None] * 6) for i, t in rows_], COLUMNS).repartition(2)
    got = sorted((r["doc_id"], r["n_removed"]) for r in rows(substring_dedup.digest(docs, substring_dedup.factors(docs))) if r["doc_id"])
    assert got == [(1, 0), (1, 0), (2, 0), (2, 80), (3, 80), (4, 0), (4, 0)]
    left = sorted((r["doc_id"], " ".join((r["text"] or "").split())) for r in rows(substring_dedup.remove_repeats(docs)) if r["doc_id"] and r["text"])
    assert left == [(1, w), (1, w), (2, u), (3, "x")]
    assert sorted(((r["doc_id"] or 0, r["text"] or "") for r in rows(near_dedup.drop_near_duplicates(docs)))) == [
        (0, w), (1, w), (2, u), (4, "")]
    near = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in rows(near_dedup.near_duplicates(docs, 3, 85)) if r["doc_id"])
    assert near == [(1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (4, 4, True), (4, 4, True)]


def test_greedy_factors_meet_at_boundaries():
    assert substring_dedup.greedy_factors([3, 4, 5, 9], [1, 1, 2, 2], 50) == [(3, 51, 1), (5, 50, 2), (9, 50, 2)]


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    from tessera.llm.tokens import vocabulary

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    placed = rows(packing.pack(common.written(packing.pieces(docs)), shard_tokens=4000))
    expected, total = [], 0
    for i, x in enumerate(texts):
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")
        total += len(ids)
        expected += [(i, k, 4096 * k, len(p), zlib.crc32(p.tobytes())) for k, p in enumerate(ids[s:s + 4096] for s in range(0, len(ids), 4096))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in placed) == expected
    by = defaultdict(list)
    for r in placed:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096
    assert len(by) <= -(-total // 4096) + 1
    assert packing.pack(common.written(packing.pieces(empty))).count() == 0
    assert sum(len(r["ids"]) for r in rows(packing.packed_sequences(docs))) == 4 * total


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2, 0)
    assert [bins.place(n) for n in (6, 7, 9, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6)]


def test_mixing(docs, texts, empty):
    got = rows(mixing.mixed_words(docs))
    assert len(got) == len(texts) and got
    total, by, aim = 0, Counter(), {}
    for r in got:
        s = [None, "s1", "s2", "s3"][r["doc_id"] % 4]
        assert r["size"] == len(words(texts[r["doc_id"]])) and r["taken"] in {r["size"] * k for k in range(4)}
        total += r["size"]
        by[s] += r["taken"]
        aim[s] = r["target"]
    assert abs(sum(aim.values()) - total) < 1e-3
    for s, t in aim.items():
        assert abs(by[s] - t) <= 0.05 * t + 5
    assert sorted(map(str, got)) == sorted(map(str, rows(mixing.mixed_words(docs.repartition(5)))))
    assert mixing.mixed_words(empty).count() == 0
    assert mixing.mix(docs).columns == docs.columns


def test_mixing_of_repeated_rows_ends_near_the_targets(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j", s) for s in "xyz" for _ in range(100)], "doc_id long, text string, source string")
    docs.repartition(4).write.parquet(f"{tmp_dir}/documents.parquet")
    stored = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for table in (stored, docs):
        got = {}
        for r in rows(mixing.mixed_words(table).withColumn("n", F.lit(1))):
            got[r["target"]] = got.get(r["target"], 0) + r["taken"]
        assert {round(t): n for t, n in got.items()} == {500: 500, 1000: 1000, 1500: 1500}
    sizes = {r["source"]: r["count"] for r in rows(mixing.mix(stored).groupBy("source").count())}
    assert sizes == {"x": 50, "y": 100, "z": 150}


def test_quality_base_counts(docs, texts, empty):
    table = common.written(quality.measured(docs))
    got = {r["doc_id"]: r for r in rows(quality.judged(table))}
    for i, t in enumerate(texts):
        w = [x.decode() for x in words(t)]
        tri = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        g = got[i]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))
        assert g["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (g["base_failed"] and g["kept"])
    kept = {r["doc_id"] for r in rows(quality.keep_quality(docs))}
    assert kept == {i for i, g in got.items() if g["kept"]}
    assert quality.judged(common.written(quality.measured(empty))).count() == 0


def test_quality_verdicts_against_brute_force(spark, texts):
    """Measures straight from the vocabularies, quantiles from sorted lists, bands group by group."""
    import base64

    import public_tokenizers
    import sentencepiece
    import tiktoken

    r = random.Random(3)
    plain = ["the", "house", "garden", "and", "little", "river", "mountain", "some", "people", "talking", "about", "weather"]
    rows_ = [(i, " ".join(r.choice(plain) for _ in range(r.randrange(60, 300))), ["es", "fr"][i % 2]) for i in range(-540, 60)]
    rows_ += [(100 + i, " ".join("".join(r.choice("абвгдеийклмнопрст") for _ in range(r.randrange(2, 8))) for _ in range(80)), "ru") for i in range(7)]
    rows_ += [(200 + i, " ".join("".join(r.choice("qxzjkvw") for _ in range(9)) for _ in range(90)), "es") for i in range(3)]
    rows_ += [(300, " ".join(["same"] * 90), "en"), (301, " ".join("\U0001F9EC\u2603" for _ in range(70)), None), (302, " ".join(plain * 9), None)]
    rows_ += [(400 + i, t, [None, "en"][i % 2]) for i, t in enumerate(texts)] + [rows_[0], rows_[0]]
    docs = spark.createDataFrame([(i, t, z, 1, "x") for i, t, z in rows_], "doc_id long, text string, lang string, script long, key string").repartition(3)
    piece = sentencepiece.SentencePieceProcessor(model_file=quality.vocabulary("piece_bpe_32k.model"))
    with open(quality.vocabulary("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    byte = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    judged = []
    for i, t, z in rows_:
        w = [x.decode() for x in (t or "").encode().split()]
        windows = Counter(zip(w, w[1:], w[2:]))
        repeat = len({k + d for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for d in range(3)})
        m = None
        if w:
            ids = [x for y in w for x in piece.encode(y)]
            chars, n = sum(map(len, w)), Counter(ids)
            m = [chars / len(ids), chars / max(1, sum(len(byte.encode_ordinary(y)) for y in w)), sum(map(piece.is_byte, ids)) / len(ids),
                 -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values())]
        script = quality.script_of(t or "")
        judged.append((i, z or script, script, len(w), len(w) < 50 or 100 * repeat > 50 * len(w), m))
    good = [x for x in judged if not x[4]]

    def middle(rows__, k):
        steps = sorted(int(x[5][k] * quality.GRID + .5) for x in rows__)
        n = len(steps)
        q25, q50, q75 = (steps[max(0, math.ceil(n * p) - 1)] for p in (.25, .5, .75))
        return n / (n + quality.PRIOR), q50 / quality.GRID, (q75 - q25) / (1.349 * quality.GRID)

    def shrunk(own, rest_middle, rest_robust):
        share, mid, robust = own
        return share * mid + (1 - share) * rest_middle, share * robust + (1 - share) * max(robust, rest_robust)

    @functools.cache
    def bands_of(group):
        mine, out = [x for x in good if x[1] == group], []
        most = max(Counter(x[2] for x in mine).items(), key=lambda x: (x[1], x[0]))[0]
        for k, (name, sides) in enumerate(quality.WIDTH.items()):
            _, a, b = middle(good, k)
            a, b = shrunk(middle([x for x in good if x[2] == most], k), a, b)
            own = middle(mine, k)
            mid, robust = shrunk(own, a, b)
            half = [w and max(w * robust, quality.LEAST[name]) / math.sqrt(own[0]) + abs(mid - own[1]) for w in sides]
            out.append((*half, mid))
        return out

    want = {}
    for i, group, script, n, failed, m in judged:
        kept = not failed
        mine = [x for x in good if x[1] == group]
        if kept and mine:
            for k, (low, high, scale) in enumerate(bands_of(group)):
                wide = math.sqrt(1 + quality.SHORT / n)
                kept &= not (low is not None and m[k] < scale - low * wide) and not (high is not None and m[k] > scale + high * wide)
        want.setdefault(i, set()).add(kept)
    got = {}
    for x in rows(quality.judged(common.written(quality.measured(docs)))):
        got.setdefault(x["doc_id"], set()).add(x["kept"])
    assert got == want and all(got[200 + i] == {False} for i in range(3)) and all(got[100 + i] == {True} for i in range(7))


def test_reply_trees(spark):
    rows_in = [(1, 0, "user", "hi </turn> \\<turn x"), (1, 1, "assistant", "tail\\\n</turn>\n"), (1, 1, "assistant", None),
               (None, 3, None, "é"), (2, None, "assistant", "ü€")]
    table = spark.createDataFrame(rows_in, "conv_id long, turn long, role string, text string")
    messages = common.written(chat_trees.linear_messages(table))
    got = {r["tree_id"]: r for r in rows(chat_trees.read_back(chat_trees.formatted(chat_trees.best_paths(messages), messages)))}
    assert [(t["role"], t["text"]) for t in got["1"]["turns"]] == [("user", "hi </turn> \\<turn x"), ("assistant", ""), ("assistant", "tail\\\n</turn>\n")]
    assert got["1"]["loss_text"] == "tail\\\n</turn>\n"
    assert got["2"]["loss_text"] == "ü€" and got[""]["loss_text"] == ""


def test_branches_rank_by_score_and_circles_go(spark):
    tree = spark.createDataFrame([("t", 1, None, 0.0), ("t", 2, 1, 1.0), ("t", 3, 1, 5.0), ("t", 4, 2, 9.0), ("t", 5, 3, 1.0),
                                  ("c", 1, 2, 0.0), ("c", 2, 1, 0.0), ("c", 3, 2, 0.0)], "tree_id string, node_id long, parent_id long, score double")
    got = [(r["branch"], r["position"], r["node_id"]) for r in rows(chat_trees.best_paths(tree, 2))]
    assert sorted(got) == [(1, 0, 1), (1, 1, 2), (1, 2, 4), (2, 0, 1), (2, 1, 3), (2, 2, 5)]


def test_nearest(spark):
    r = np.random.default_rng(2)
    m = r.normal(size=(300, 8)).round(2)
    m[10:20] = m[9]
    data = [(i, [float(x) for x in v], 0) for i, v in enumerate(m)] + [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [1.0], 0)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for x in rows(ann_forest.nearest(table, F.col("vec_id") % 50 == 0, most=10 ** 6)):
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert sorted(got) == [0, 50, 100, 150, 200, 250]
    for q, found in got.items():
        s = u @ u[q]
        s[q] = -9
        best = sorted(range(300), key=lambda i: (-round(s[i], 12), i))[:5]
        assert [v for _, v, _ in sorted(found)] == best
    assert ann_forest.nearest(table.limit(0), F.lit(True)).count() == 0


def test_repeated_tokens_against_brute_force():
    r = random.Random(3)
    for _ in range(60):
        pages = [np.array([r.randrange(3) for _ in range(r.randrange(14))], np.int64) for _ in range(r.randrange(2, 5))]
        n = r.randrange(2, 5)
        for k, (p, got) in enumerate(zip(pages, html_text.repeated_tokens(pages, n))):
            own = np.zeros(len(p), bool)
            for i in range(len(p) - n + 1):
                w = p[i:i + n].tolist()
                if any(o[j:j + n].tolist() == w for q, o in enumerate(pages) if q != k for j in range(len(o) - n + 1)):
                    own[i:i + n] = True
            assert (own == got).all()


def test_main_text(spark):
    notice = "Please accept all of our cookies to read on here now"
    pages = [(1, "http://a.b/x", "<nav>m</nav><article><h1>T &amp; U</h1><p>one <b>two</b>\n x<br>y<p>z<div class='ad'>no</div></article><footer>f</footer>"),
             (2, "http://a.b/y", f"<body><p>{notice}</p><p>first own text</p><script>1</script></body>"),
             (3, "http://a.b/z", f"<body><p>second own text</p><p>{notice}</p></body>"), (4, None, None), (5, "http://a.b/", "")]
    got = {r["page_id"]: r["text"] for r in rows(html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")))}
    assert got == {1: "T & U\none two x y\nz", 2: "first own text", 3: "second own text", 4: "", 5: ""}


def test_language_fusion(spark):
    docs = spark.createDataFrame([(1, "the house and the garden of the king", "en"), (2, "la maison et le jardin du roi est belle", "fr"),
                                  (3, None, "en"), (4, "x", None)], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://h.fr/fr/1", "<html lang='fr'><p>le jardin et la maison"), (2, "http://h.com/", "<p>the king and the garden"),
                                   (3, "http://h.fr/fr/3", ""), (4, None, None)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in rows(language_id.identify(pages, docs))}
    assert got[1]["lang"] == "fr" and got[2]["lang"] == "en" and got[3]["lang"] == "fr" and len(got) == 4
    assert all(abs(sum(r["posterior"]) - 1) < 1e-9 for r in got.values())
    assert language_id.identify(pages, docs.limit(0)).where("lang is null").count() == 4


def brute_posteriors(pages, names, model, hosts):
    """The fusion for every page by plain sums over all the other rows."""
    k = len(names)
    soften = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    own = []
    for _, url, page in pages:
        n = language_id.trigrams(language_id.plain(page or ""))
        ll = (n @ model.T) * min(1.0, language_id.TRIGRAMS / max(1, n.sum()))
        declared = re.search(r"<html[^>]*\slang=['\"]?([a-zA-Z]{2,3})", page or "")
        first = re.match(r"[a-z]+://[^/?#]*/([a-zA-Z]{2,3})(?:[/?#]|$)", url or "")
        host = hosts[url]
        own.append((ll, soften(ll), {"host": host, "domain": ".".join(host.split(".")[-2:]), "top": host.split(".")[-1],
                                     "declared": declared and declared[1].lower(), "suffix": first and first[1].lower()}))
    every = sum((s for _, s, _ in own), np.zeros(k))
    out = []
    for j, (ll, soft, keys) in enumerate(own):
        rest = {by: sum((s for i, (_, s, o) in enumerate(own) if i != j and o[by] == keys[by]), np.zeros(k)) for by in keys}
        others = every - soft
        prior = (others + 1) / (others.sum() + k)
        for by, a in (("top", 20), ("domain", 10), ("host", 5)):
            prior = (rest[by] + a * prior) / (rest[by].sum() + a)
        total = ll + np.log(prior)
        for by in ("declared", "suffix"):
            if keys[by] is not None:
                total = total + np.log((rest[by] + .5) / (every + 1))
        out.append(soften(total))
    return out


def test_language_posteriors_against_brute_force(spark):
    r = random.Random(7)
    vocab = {"en": "the house and garden of a king with many words", "fr": "la maison et le jardin du roi avec des mots", "de": "das haus und der garten vom mann mit worten"}
    docs = [(i, " ".join(r.choice(vocab[z].split()) for _ in range(20)), z) for i, z in enumerate(["en", "fr", "de"] * 8)]
    docs = spark.createDataFrame([(i, t, z, 1.0) for i, t, z in docs], "doc_id long, text string, lang string, prior double")
    pages = []
    for i in range(60):
        z = r.choice(list(vocab))
        host = r.choice([f"{z}.site.org", f"a.{z}", "www.mixed.com", f"{z}.mixed.com"])
        lang = r.choice(["", f" lang='{z}'", ' class="x" lang=EN'])
        words_ = " ".join(r.choice(vocab[z].split()) for _ in range(r.choice([0, 1, 3, 60])))
        pages.append((i, f"http://{host}/{r.choice([z, z.upper() + '/x', 'page', ''])}", f"<html{lang}><p>{words_}</p>"))
    pages += [pages[3], pages[3], (100, None, None), (101, None, "<p>das haus"), (102, "http://h.fr", ""), (103, "", "<html lang=zz>"), (None, "http://h.fr", "<p>le roi")]
    table = spark.createDataFrame([(*p, "x", 0.5, "h") for p in pages], "page_id long, url string, html string, lang string, prior double, host string").repartition(3)
    names, model = language_id.fit(docs)
    hosts = {x["url"]: x["h"] for x in rows(table.select("url", html_text.host_of(F.col("url")).alias("h")).distinct())}
    assert names == ["de", "en", "fr"]
    want = sorted((str(p[:2]), [round(float(x), 6) for x in w]) for p, w in zip(pages, brute_posteriors(pages, names, model, hosts)))
    got = rows(language_id.identify(table, docs))
    assert sorted((str((g["page_id"], g["url"])), [round(x, 6) for x in g["posterior"]]) for g in got) == want
    for g in got:
        assert g["lang"] == names[int(np.argmax(g["posterior"]))] and g["confidence"] == max(g["posterior"])


def test_lattice_sums_all_segmentations():
    from tessera.llm.tokens import vocabulary

    sp, plain, byte_ids = lm_scoring.piece_table(vocabulary("piece_bpe_32k.model"))
    r = np.random.default_rng(1)
    logp = np.log(r.dirichlet(np.ones(len(plain)), 2))
    lattice = lm_scoring.Lattice(vocabulary("piece_bpe_32k.model"))
    ids = {p: i for i, p in enumerate(plain) if p}

    def brute(s, z):
        if not s:
            return 1.0
        out = sum(math.exp(logp[z, ids[s[:k]]]) * brute(s[k:], z) for k in range(1, len(s) + 1) if s[:k] in ids)
        if s[0] not in ids:
            out += math.exp(sum(logp[z, byte_ids[b]] for b in s[0].encode())) * brute(s[1:], z)
        return out

    tests = ["then", "a", "élan", "straße", "ሴx", "😀"]
    got = lattice.marginals(tests, logp)
    for w, row in zip(tests, got):
        for z in (0, 1):
            assert abs(row[z] - math.log(brute("▁" + w, z))) < 1e-9
    assert lattice.marginals([], logp).shape == (0, 2)


def test_word_tokens_are_the_tokenizers():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tessera.llm import tokens as module
    from tessera.llm.tokens import WordTokens, vocabulary

    plain = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    r = np.random.default_rng(5)
    signs = [chr(c) for c in range(33, 127)] + list("abcdefghijABC0123'.,éÉñßÿ×÷ª字Å\u0301\u212bİ\x1c\x7fﬁ")
    words = ["".join(r.choice(signs, r.integers(1, 12)).tolist()) for _ in range(4000)] + ["don't", "Él's", "<|endoftext|>", "</w>", "ÀÖØÞ.", "x<|endoftext|>Y.", "<|ENDOFTEXT|>", "<|startoftext|>0<|endoftext|>", "<|endoftext"]
    words = [w.encode() for w in words if w.encode().split() == [w.encode()]]
    tokens = WordTokens(vocabulary("word_bpe_49k.json"))
    tokens.encode(words)
    for w in words:
        assert tokens.known[w] == np.array(plain.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()
    texts = [" ".join(w.decode() for w in words[i:i + 70]) for i in range(0, len(words), 70)] + [None, "", " \t", "\n lead", "trail ", " ".join(w.decode() for w in words)]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for limit, chunk in ((1 << 20, 1 << 20), (20_000, 500)):  # a small cache forgets, a small chunk parts often
        module.CHUNK, old = chunk, module.CHUNK
        try:
            assert list(WordTokens(vocabulary("word_bpe_49k.json"), limit).encode_texts(pa.array(texts, pa.string()))) == want
        finally:
            module.CHUNK = old


def test_lm_scores(docs, texts, empty):
    got = {r["doc_id"]: r for r in rows(lm_scoring.scores(docs))}
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    lists = [(t or "").encode().lower().split() + [b" "] for t in texts]
    c = Counter(w for x, h in zip(lists, held) if not h for w in x)
    n, v = sum(c.values()), len(c)
    for i, x in enumerate(lists):
        g = got[i]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (held[i], len(x), sum(c[w] > 0 for w in x), n)
        assert abs(base - g["base_score"]) < 1e-6 * abs(base) and -math.inf < g["score"] < 0
    # the model: counts in the class, backed by those of all classes, backed by the lattice; summed over the classes
    path = "piece_bpe_32k.model"
    langs = [[None, "en", "fr"][i % 3] for i in range(len(texts))]
    names = sorted({x for x, h in zip(langs, held) if x and not h}, key=lambda x: (-sum(y == x and not h for y, h in zip(langs, held)), x))
    z_of = [names.index(x) if x in names else len(names) for x in langs]
    k = len(names) + 1
    per = [Counter(w for x, h, z in zip(lists, held, z_of) if not h and z == j for w in x) for j in range(k)]
    frame = lm_scoring.word_counts(lm_scoring._prepared(docs, names), k)
    every = sorted({w.decode() for x in lists for w in x[:-1]})
    marginal = dict(zip(every, lm_scoring.lattice_of(path).marginals(every, lm_scoring.piece_weights(frame, k, path)).tolist()))
    d, kinds = lm_scoring.DISCOUNT, v - 1

    def log_p(w, j):
        rest = math.exp(marginal[w.decode()][j])
        rest = .9 * rest + .1 * (max(c[w] - d, 0) / (n + 1) + (d * kinds + .5) / (n + 1) * rest)
        own, words_ = sum(per[j].values()), len([x for x in per[j] if x != b" "])
        return math.log(max(per[j][w] - d, 0) / (own + 1) + (d * words_ + .5) / (own + 1) * rest)

    ends = [per[j][b" "] for j in range(k)]
    for i, x in enumerate(lists):
        by = [math.log((ends[j] + .5) / (sum(ends) + .5 * k)) + math.log((ends[j] + .5) / (sum(per[j].values()) + 1)) + sum(log_p(w, j) for w in x[:-1])
              for j in range(k)]
        want = (max(by) + math.log(sum(math.exp(b - max(by)) for b in by))) / math.log(10)
        assert abs(got[i]["score"] - want) < 1e-6 * abs(want), i
    twice = rows(lm_scoring.scores(docs.union(docs)))
    assert len(twice) == 2 * len(texts)
    assert lm_scoring.scores(empty).count() == 0


def test_components_of_a_long_chain(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(500, 501)], "a long, b long")
    got = {r["node"]: r["label"] for r in rows(common.components(edges))}
    assert got == {**{i: 0 for i in range(200)}, 500: 500, 501: 500}


def test_pipeline_stages_take_effect(spark, docs, texts):
    import corpus_pipeline as cp

    kept = common.written(cp.quality(spark, docs, ""))
    single = common.written(cp.near_dedup(spark, kept, ""))
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect())
    groups = components([texts[i] for i in ids], 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == [ids[k] for k, (_, c) in enumerate(groups) if c == k]
    cut = common.written(cp.substring_dedup(spark, single, ""))
    mixed = common.written(cp.mixing(spark, cut, ""))
    assert cut.columns == mixed.columns == docs.columns
    packed = cp.packing(spark, mixed, "")
    assert packed.where("piece = 0").count() == mixed.count()


def test_quality_words_of_many_texts_are_looked_up_once(monkeypatch):
    texts = ["", " ", "  b a \n", "\n\n", "\x1c x", "é", "a b c a b c\na b c\na b c\n", "x" * 9] * 300
    parts = list(tokens.parted(pa.array(texts), 4000))
    assert [t for part in parts for t in part[0]] == texts and len(parts) > 2
    learned = []
    fertility = quality.Fertility("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken")
    monkeypatch.setattr(fertility, "of", lambda words, of=fertility.of: learned.extend(words) or of(words))
    for some, words, which, cuts in parts:
        assert len(set(words)) == len(words)
        assert [[words[k] for k in which[i:j]] for i, j in zip(cuts, cuts[1:])] == [t.encode().split() for t in some]
        learned.clear()
        ids, upto, byte_upto = fertility.split(words, which)
        assert learned == words  # each distinct word once, not each word of each text
        for t, i, j in zip(some, cuts, cuts[1:]):
            own = t.encode().split()
            assert ids[upto[i]:upto[j]].tolist() == [x for w in own for x in fertility.piece.encode(w.decode())]
            assert byte_upto[j] - byte_upto[i] == sum(len(fertility.byte.encode_ordinary(w.decode())) for w in own)


def test_long_rows_go_to_python_in_small_batches(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, f"a{i % 7} " * 60) for i in range(4000)], "doc_id long, text string").coalesce(1)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
    with common.small_batches(spark):
        own = [r["n"] for r in common.written(sizes).collect()]
    assert sum(own) == 4000 and max(own) <= common.BATCH_ROWS
    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        1 / 0
    assert spark.conf.get(name) == before

    seen = []

    def spy(df):
        if "mapInArrow" in (plan := df._jdf.queryExecution().optimizedPlan().toString()) or "MapInArrow" in plan:
            seen.append(int(spark.conf.get(name)))
        return common.written(df)

    for module in (near_dedup, quality, substring_dedup):
        monkeypatch.setattr(module, "written", spy)
    quality.keep_quality(docs.withColumn("lang", F.lit("x"))).count()
    near_dedup.near_duplicates(docs).count()
    substring_dedup.remove_repeats(docs).count()
    assert len(seen) >= 6 and max(seen) <= common.BATCH_ROWS  # texts, sets and windows
    assert spark.conf.get(name) == before
