"""Vector search, vector near-duplicates, page text, quality and URL filters by brute force."""

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import html, pq, quality, topk, urls
from eventlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows, base = [], rng.normal(size=(12, 16))
    for i in range(400):
        x = base[i % 12] + rng.normal(size=16) * rng.choice([0.02, 0.12, 1.0])
        rows.append((i, [float(v) for v in np.float32(x)], [1, 2, None][i % 7 % 3]))
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [NAN] * 16, 1), (2003, [INF] + [1.0] * 15, 1)]
    rows += [(2004, [None] + [1.0] * 15, 1), (2005, [1.0, 2.0], 1), (2006, [2.0, 4.0], 1), (2007, [], 1), (None, rows[0][1], 1)]
    rows = [(*r, 0, 0) for r in rows]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x int, node int")


def valid(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


@pytest.mark.parametrize("block", [64, 4096])
def test_top_k(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows, df = vectors
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["key"], r["score"]))
    points = [(r[0], np.floor(256 * np.array(r[1], dtype=float)).astype(int)) for r in rows if valid(r[1]) and r[0] is not None]
    for key, x in points:
        if key % 50:
            continue
        best = sorted((-int(x @ y), k) for k, y in points if k != key and len(y) == len(x))[:5]
        assert sorted(got.pop(key)) == [(i + 1, k, -s) for i, (s, k) in enumerate(best)]
    assert not got
    assert topk.top_k(df.limit(0), F.col("vec_id") == 1).count() == 0


def test_top_k_of_many_blocks_and_copies(spark, monkeypatch):
    """Blocks on both sides, one part searched first, large groups of equal and of odd vectors."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "LARGEST", 8 * 20)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 8))
    x[::3] = x[0] + rng.normal(size=(len(x[::3]), 8)) * 0.01
    x[100:300] = x[7]
    x[650:] *= 1e4
    keys = rng.permutation(700)
    rows = [(int(k), v.tolist()) for k, v in zip(keys, x, strict=True)]
    rows += rows[90:110] + [(int(keys[0]), x[1].tolist()), (int(keys[20]), (-x[1]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 7 == 0).collect():
        got.setdefault(r["query"], []).append((r["rank"], r["key"], r["score"]))
    points = list(dict.fromkeys((k, tuple(np.floor(256 * np.array(v)).astype(int).tolist())) for k, v in rows))
    want = {}
    for key, a in points:
        if key % 7 == 0:
            best = sorted((-sum(map(int.__mul__, a, b)), k) for k, b in points if k != key)[:5]
            want.setdefault(key, []).extend((i + 1, k, -s) for i, (s, k) in enumerate(best))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_a_cover_tree_covers():
    x = np.random.default_rng(1).normal(size=(700, 3))
    todo, leaves = [topk.cover_tree(x)], []
    while todo:
        node = todo.pop()
        assert (np.linalg.norm(x[node.rows] - node.center, axis=1) <= node.radius + 1e-12).all()
        todo += node.children
        leaves += [] if node.children else node.rows.tolist()
    assert sorted(leaves) == list(range(700))


@pytest.mark.parametrize("block,per_list", [(2048, 1024), (16, 40)])
def test_vector_near_duplicates(spark, vectors, monkeypatch, block, per_list):
    monkeypatch.setattr(pq, "BLOCK", block)
    monkeypatch.setattr(pq, "PER_LIST", per_list)
    rows, df = vectors
    ok = [valid(r[1]) and any(r[1]) and r[2] is not None for r in rows]
    unit = [np.array(r[1]) / np.linalg.norm(r[1]) if o else None for r, o in zip(rows, ok, strict=True)]

    def linked(i, j):
        return i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93

    near = [[j for j in range(len(rows)) if linked(i, j)] for i in range(len(rows))]
    found = {r["key"]: (r["n_links"], r["component"]) for r in pq.near_duplicates(df).collect()}
    assert len(found) == len(rows)
    root = [r[0] if r[0] is not None else 10**9 for r in rows]
    for _ in range(50):
        root = [min([root[i], *(root[j] for j in near[i])]) for i in range(len(rows))]
    links = sum(map(len, near))
    assert sum(n for n, _ in found.values()) >= 0.9 * links
    exact = sum(found[r[0]] == (len(near[i]), root[i]) for i, r in enumerate(rows))
    assert exact >= 0.97 * len(rows)
    assert all(found[k] == (0, k) for k in (2000, 2001, 2002, 2003, 2004, 2007))
    assert found[2005] == found[2006] == (1, 2005)
    assert pq.near_duplicates(df.limit(0)).count() == 0


def paired_groups(n=4000, pairs=100, dim=64):
    """Tight groups in pairs whose centres are at a cosine of 0.945; a tenth of the rows is noise."""
    rng = np.random.default_rng(12)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    a = unit(rng.normal(size=(pairs, dim)))
    side = rng.normal(size=(pairs, dim))
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    centers = np.concatenate([a, 0.945 * a + np.sqrt(1 - 0.945**2) * side])
    x = centers[rng.integers(0, 2 * pairs, n)] + rng.normal(size=(n, dim)) * 0.002
    x[::10] = rng.normal(size=(len(x[::10]), dim))
    return unit(x)


@pytest.mark.parametrize("lists", [128, 512])
def test_many_lists_lose_no_link(spark, monkeypatch, lists):
    x = paired_groups()
    monkeypatch.setattr(pq, "PER_LIST", -(-len(x) // lists))
    near = x @ x.T >= 0.93
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r["key"]: (r["n_links"], r["component"]) for r in pq.near_duplicates(df).collect()}
    root = np.arange(len(x))
    for _ in range(50):
        root = np.where(near, root[None, :], len(x)).min(1)
    assert got == {i: (int(near[i].sum()) - 1, int(root[i])) for i in range(len(x))}


def test_links_over_many_blocks(spark, monkeypatch, tmp_path):
    """Blocks on both sides; a vector is copied to as many tasks as its label has blocks, not lists."""
    monkeypatch.setattr(pq, "BLOCK", 64)
    monkeypatch.setattr(pq, "LARGEST", 64 * 80)
    monkeypatch.setattr(pq, "PER_LIST", 5)
    compare = pq.compare

    def spied(index, q, x, threshold):
        with open(f"{tmp_path}/{os.getpid()}-{id(q)}-{random.random()}", "w") as file:
            file.write(str(len(q.x) + (len(x.x) if x else 0)))
        return compare(index, q, x, threshold)

    monkeypatch.setattr(pq, "compare", spied)
    x = np.float32(paired_groups(600))
    x[7] = 1000 * x[5]
    labels = [1 if i % 6 else 2 for i in range(len(x))]
    rows = [(i, v.tolist(), n) for i, (v, n) in enumerate(zip(x, labels, strict=True))]
    rows += [(1000 + i, x[8].tolist(), 1) for i in range(50)] + [(2000, (-x[8]).tolist(), 1), (2001, x[8].tolist(), None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["key"]: (r["n_links"], r["component"]) for r in pq.near_duplicates(df).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] or -i for i, r in enumerate(rows)])
    near, keys = (v @ v.T >= 0.93) & (label[:, None] == label), np.array([r[0] for r in rows])
    root = keys
    for _ in range(60):
        root = np.where(near, root[None, :], 10**6).min(1)
    root[-1] = 2001
    assert got == {int(k): (max(0, int(n) - 1), int(c)) for k, n, c in zip(keys, near.sum(1), root, strict=True)}
    copies = sum(int(file.read_text()) for file in tmp_path.iterdir())
    blocks = {n: -(-sum(r[2] == n for r in rows) // 80) for n in (1, 2)}
    assert copies <= sum(blocks[r[2]] for r in rows if r[2])


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="ad">Buy this. Now.</div><!-- <p>x</p> -->
<article><h1>A  title &amp; more</h1><p><b>First words<br>on two&nbsp;lines &#233; here, in a sentence.<p>Second one. It has
some words, too.</p><form>Name <input></form><div class="comments"><p>Great text! I liked it.</p></div></article>
<footer>&copy; somebody. All rights.</footer></body></html>"""


def test_page_text(spark):
    pages = [(i, "u", PAGE.replace("First", f"First{i}")) for i in range(20)]
    pages += [(100, None, None), (101, "u", ""), (102, "u", PAGE[: PAGE.index("some words") + 4]), (103, "u", "<" * 5000)]
    pages += [(104, "u", "<article>" + "<p>Many words in a long row. " * 20_000), (0, "u", pages[0][2]), (None, "u", PAGE)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, page string")
    rows = html.main_text(df).collect()
    assert len(rows) == len(pages)
    text = {r["key"]: r["text"] for r in rows}
    want = "A title & more\n\nFirst{} words on two lines é here, in a sentence.\n\nSecond one. It has some words, too."
    assert [text[i] for i in range(20)] == [want.format(i) for i in range(20)]
    assert text[100] == text[101] == "" and text[102].endswith("It has some")
    assert text[104].count("Many words") == 20_000
    assert html.main_text(df.limit(0)).count() == 0


def test_page_text_of_another_template():
    counts = {k: 300 * n for k, n in html.page_counts(PAGE).items()}
    page = """<body><header><h1>Site</h1></header><div class="cookie-notice"><p>We use cookies. Accept now.</p></div>
    <div id="content"><h2>Title</h2><p>A long text of many words, with a <a href=x>link</a> in it. And so on.</p>
    <aside>Other things to read.</aside></div><div class="sidebar"><p>More. And more.</p></div><footer>c</footer>"""
    text = html.Model(counts).extract(page)
    assert text == "Title\n\nA long text of many words, with a link in it. And so on."


def test_a_head_without_an_end_and_closed_drawings_hide_nothing():
    model = html.Model({k: 300 * n for k, n in html.page_counts(PAGE).items()})
    body = "<article><p>Some words, in a long sentence. And more.</p></article>"
    want = "Some words, in a long sentence. And more."
    for page in (
        f"<html><head><title>T</title><meta charset=x><body>{body}</html>",
        f"<html><head><title>T</title>{body}</html>",
        f"<html><head><title>T</title></head><body>{body}</html>",
        f'<body><article><svg width="1"/><math/>{body}</article>',
        f"<body><article><svg><title/><path/></svg>{body}</article>",
        f"<head><body>{body}<head>",
    ):
        assert model.extract(page) == want, page
    bare = html.parse("<head><title>T</title> Words of the body")[1]
    assert [t for _, t in bare] == ["Words of the body"]
    assert html.parse("<body><p>a<svg><text>no</text></svg>b")[1][0][1] == "ab"


def test_deep_and_broken_pages_take_no_long_time():
    model = html.Model({k: 300 * n for k, n in html.page_counts(PAGE).items()})
    for part in ("<div>", "<span>", "<li>", "</p>", "<b><p>", '<a href="', "<table><tr><td>", "&amp;<"):
        model.extract(part * 20_000 + "end")


def test_quality_is_learned_from_other_folds_only(spark):
    rng = random.Random(2)
    good = ["".join(rng.choice("abcdefgh ") for _ in range(200)) for _ in range(300)]
    rows = [(i, t if i % 3 else t.upper().replace(" ", "!! ")) for i, t in enumerate(good)]
    labels = [(i, int(i % 3 > 0), 0) for i, _ in rows] + [(0, None, 0)]
    rows += [(5000, None), (5001, ""), (None, "x y"), (1, rows[1][1]), (5002, "word " * 200_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.scores(df, labelled).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["key"] is not None and r["key"] < 300 and zlib.crc32(str(r["key"]).encode()) % 4 == 2]
    assert sum((r["score"] >= 0.7) == (r["key"] % 3 > 0) for r in held) >= 0.95 * len(held) > 20
    flipped = labelled.withColumn("quality", F.when(quality.fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["key"]: r["score"] for r in quality.scores(df, flipped).collect()}
    assert all(abs(again[r["key"]] - r["score"]) < 1e-6 for r in got)
    kept = quality.keep_good(df, labelled)
    assert kept.columns == df.columns and kept.where("doc_id % 3 = 0 AND doc_id < 300").count() < 8
    assert quality.keep_good(df, labelled.limit(0)).count() == len(rows)
    assert quality.scores(df.limit(0), labelled).count() == 0
    assert {r["score"] for r in quality.scores(df, labelled.limit(0)).collect()} == {0.5}


def test_lists_are_read_as_of_the_fetch(spark):
    rng = random.Random(9)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.org", "deep.a.example.com"]
    rules = ["domain:example.com", "domain:a.example.com", "host:x.org", "url:x.org/p/1", "host:nowhere.net"]
    times = [0, 1, 15, 16, 17, 255, 256, 4096, 86_400_000_000, 86_400_000_001, 1_700_000_000_000_000]
    changes = [(rng.choice(rules), rng.choice(times), rng.choice(["block", "allow", None])) for _ in range(60)]
    changes += [(None, 1, "block"), ("host:x.org", None, "block")]
    captures = [(i, f"https://{rng.choice(hosts)}/p/{i % 2}?q#f", rng.choice(times) + rng.randrange(3)) for i in range(300)]
    captures += [(500, None, 5), (501, "no url", 5), (502, "http://x.org/p/1", None), (0, *captures[0][1:])]
    got = urls.judge(
        spark.createDataFrame([(*c, "r") for c in captures], "key long, url string, at long, row string"),
        spark.createDataFrame(changes, "rule string, at long, action string"),
    ).collect()
    assert len(got) == len(captures)

    def state(rule, at):
        past = [(t, a or "", a) for r, t, a in changes if r == rule and t is not None and t <= at]
        return max(past)[2] if past else None

    for r in got:
        host = r["url"].split("/")[2] if r["url"] and "//" in r["url"] else None
        keys = []
        if host and r["at"] is not None:
            path = r["url"].split(host)[1].split("?")[0]
            labels = host.split(".")
            keys = [f"domain:{'.'.join(labels[-n:])}" for n in range(2, len(labels) + 1)] + [f"host:{host}", f"url:{host}{path}"]
        active = [(k, state(k, r["at"])) for k in keys if state(k, r["at"])]
        assert (r["n_active"], r["rule"], r["action"]) == (len(active), *(active[-1] if active else (None, None)))
    empty = spark.createDataFrame([], "rule string, at long, action string")
    assert {r["n_active"] for r in urls.judge(spark.createDataFrame(captures, "key long, url string, at long"), empty).collect()} == {0}


def test_lists_hold_dates_of_any_year(spark):
    never, before, now = 253_402_300_799_000_000, -62_135_596_800_000_000, 1_600_000_000_000_000
    low, high = -(1 << 63), (1 << 63) - 1
    changes = [("host:a.org", now, "block"), ("host:a.org", never, None)]
    changes += [("host:b.org", before, "allow"), ("host:b.org", -5, "block"), ("host:b.org", now, None)]
    changes += [("host:c.org", low, "block"), ("host:c.org", high - 3, "allow"), ("host:d.org", high, "block")]
    times = [low, low + 1, before - 1, before, -6, -5, -1, 0, 7, now - 1, now, 5 * 10**15, never - 1, never, high - 4, high - 3, high - 1]
    captures = [(i, f"https://{h}.org/", t) for i, (h, t) in enumerate((h, t) for h in "abcd" for t in times)]
    got = urls.judge(
        spark.createDataFrame(captures, "key long, url string, at long"),
        spark.createDataFrame(changes, "rule string, at long, action string"),
    ).collect()
    assert len(got) == len(captures)
    for r in got:
        past = [(t, a) for rule, t, a in changes if rule == "host:" + r["url"][8:-1] and t <= r["at"]]
        want = max(past, key=lambda p: p[0])[1] if past else None
        assert (r["n_active"], r["action"]) == (int(want is not None), want), r


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.dtypes == docs.dtypes
        before = after
    rows = QUERIES["pipeline"](spark, SF)
    assert rows.count() > 10 and "ids" in rows.columns
