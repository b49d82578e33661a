"""Lexical search, manifests and piece encoding against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from eventlake.llm import lexical, manifest, pieces
from eventlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def oracle(name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    rows = con.execute(ORACLES[name])
    names = [d[0] for d in rows.description]
    return names, sorted(rows.fetchall(), key=repr)


def same_as_sql(spark, name):
    names, want = oracle(name)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == want and want


# -- lexical search ------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, queries, k):
    """Every query against every document."""
    counts = [(key, Counter(words(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        found = []
        for key, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            score = 0
            for t in set(words(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, key is None, key or 0))
        found = sorted(found)[:k]
        out += [(item, i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(found)]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 3, 20, 60, 200])
        text = " ".join(vocabulary[min(int(rng.expovariate(0.03)), 299)] for _ in range(size))
        rows.append((i, text, "a"))
    rows += [(None, "w1 w2 w299", "a"), (7, "w1 w2 w299", "b"), (7, "w1 w2 w299", "b"), (n + 1, None, "c")]
    rows += [(n + 2, "İstanbul STRASSE-straße w5\x00w6 日本語 w7" + " long" * 50_000, "c"), (n + 3, " .,;\t\n", None)]
    return rows + [(n + 10 + i, rows[3][1], "copies") for i in range(40)]


ASKED = [(1, "w1 w2 W299"), (1, "w1 w2 W299"), (2, None), (3, ""), (4, "nowhere"), (None, "w5,w6;w7 日本語"), (5, "LONG")]


@pytest.mark.parametrize("bucket, focus, share", [(2048, 12, 0.02), (7, 2, 0.05), (64, 0, 0.5)])
def test_search_equals_brute_force(spark, docs, monkeypatch, bucket, focus, share):
    monkeypatch.setattr(lexical, "FIRST_SHARE", share)
    rows = corpus(1, 400)
    asked = ASKED + [(10 + i, rows[i * 7][1]) for i in range(30)]
    queries = spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, key string")
    if bucket != 64:
        got = lexical.search(docs(rows).repartition(5), queries, 3).collect()
        assert sorted((tuple(r) for r in got), key=repr) == ranked([(k, t) for k, t, _ in rows], asked, 3)
    # The same bucket by bucket in one process, where bucket size and focus can be changed.
    monkeypatch.setattr(lexical, "FOCUS", focus)
    check_buckets(rows, asked, bucket)


def check_buckets(rows, asked, size):
    counts = [(k, Counter(lexical.terms(t))) for k, t, _ in rows if lexical.terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, q in asked for t in lexical.terms(q)}))}
    df = Counter(vocabulary[t] for _, c in counts for t in c if t in vocabulary)
    named = [sorted({vocabulary[t] for t in lexical.terms(q)}) for _, q in asked]
    block = lexical._block(named, df, len(vocabulary), n_docs)
    vectors = []
    for key, c in counts:
        mean = 10 + (90 * sum(c.values()) * n_docs) // n_terms
        x = {vocabulary[t]: int(block.weight[vocabulary[t]]) * ((10**9 * n) // (1000 * n + 8 * mean)) for t, n in c.items() if t in vocabulary}
        x = {t: v for t, v in x.items() if v}
        if x:
            vectors.append((math.sqrt(sum(v * v for v in x.values())), key, x))
    vectors.sort(key=lambda v: -v[0])
    best, scored = lexical.Best(len(asked), 3, np.zeros(len(asked))), 0
    for at in range(0, len(vectors), size):
        part = vectors[at : at + size]
        row = np.array([i for i, (_, _, x) in enumerate(part) for _ in x])
        term = np.array([t for _, _, x in part for t in x])
        value = np.array([v for _, _, x in part for v in x.values()])
        keys = np.array([k or 0 for _, k, _ in part])
        null = np.array([k is None for _, k, _ in part])
        scored += lexical.search_bucket(block, best, keys, null, np.array([v[0] for v in part]), row, term, value)
    got = sorted(zip(best.query.tolist(), (-best.score).tolist(), best.null.tolist(), best.key.tolist(), strict=True))
    want = ranked([(k, t) for k, t, _ in rows], [(q, t) for q, (_, t) in enumerate(asked)], 3)
    assert sorted((q, -s, k is None, k or 0) for q, _, k, s in want) == got
    assert scored < len(vectors) * len(asked)
    if size == 7:
        assert scored < len(vectors) * len(asked) / 4  # most pairs never are scored


def test_search_in_several_blocks_of_queries(spark, docs, monkeypatch):
    monkeypatch.setattr(lexical, "QUERIES_IN_BLOCK", 3)
    rows = corpus(2, 80)
    queries = spark.createDataFrame(ASKED, "item_id long, text string")
    got = lexical.search(docs(rows), queries, 2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == ranked([(k, t) for k, t, _ in rows], ASKED, 2)


def test_search_of_nothing(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(ASKED, "item_id long, text string")
    names = ["item", "rank", "key", "score"]
    for found in (lexical.search(docs([]), some), lexical.search(docs(corpus(1, 5)), none), lexical.search(docs([(1, None, "a")]), some)):
        assert found.columns == names and found.count() == 0


def test_registered_search_equals_sql(spark):
    same_as_sql(spark, "op11_lexical")


# -- manifest ------------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    """Levels of a tree, and of each leaf the siblings on its way up."""
    levels, paths, at = [nodes], [[] for _ in nodes], list(range(len(nodes)))
    while len(levels[-1]) > 1:
        low = levels[-1]
        for i, p in enumerate(paths):
            first = at[i] // 8 * 8
            p.append((low[first : at[i]], low[at[i] + 1 : first + 8]))
            at[i] //= 8
        levels.append([h("".join(low[i : i + 8])) for i in range(0, len(low), 8)])
    return levels, paths


def plain_manifest(rows, change):
    def leaf_of(row, text):
        values = (row[0], row[2], row[1], row[3], text)
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    leaves = {}
    for row in rows:
        key = (row[0] is not None, row[0] or 0, leaf_of(row, row[4]))
        leaves.setdefault(row[1], []).append((key, row[0], leaf_of(row, change(row))))
    names = sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        leaves[name].sort(key=lambda v: (v[0], v[2]))
    trees = {name: tree([v[0][2] for v in leaves[name]]) for name in names}
    top, above = tree([trees[name][0][-1][0] for name in names])
    out = []
    for g, name in enumerate(names):
        for i, (key, doc, changed) in enumerate(leaves[name]):
            path = trees[name][1][i] + above[g]
            node, nodes = changed, [changed]
            for before, after in path:
                node = h("".join(before) + node + "".join(after))
                nodes.append(node)
            proof = "".join("".join(b) + "".join(a) for b, a in path)
            copied = tuple(nodes) if changed != key[2] else None
            out.append((doc, name, key[2], top[0][0] and trees[name][0][-1][0], top[-1][0], proof, copied, node, node == top[-1][0]))
    return sorted(out, key=repr), trees, top[-1][0]


@pytest.fixture(scope="module")
def table(spark):
    def build(rows):
        rows = [(*r, "x", 1, "y") for r in rows]
        kinds = "doc_id long, lang string, source string, n_chars long, text string, g string, pos int, digest string"
        return spark.createDataFrame(rows, kinds)

    return build


def lowered(row):
    tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
    return row[4].translate(LOWER) if tampered and row[4] is not None else row[4]


def manifest_of(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", manifest.UPPER, manifest.UPPER.lower())
    change = {"text": F.when(tampered, lower).otherwise(F.col("text"))}
    return manifest.build(df, order="doc_id", group="lang", fields=FIELDS, changed=change)


def some_rows():
    rng = random.Random(5)
    rows = [(i, "big", "s", i % 7, f"Text {rng.random()} É") for i in range(-600, 700)]
    rows += [(i, "exact", "s", None, f"T{i}") for i in range(512)]
    rows += [(i, None, None, 3, "No language") for i in (5, 1, 9)]
    rows += [(i, "", "", 0, "") for i in range(9)] + [(3, "one", "s", 1, None), (4, "é", "s", 1, "T" * 300_000)]
    rows += [(None, "big", "s", 1, "Null A"), (None, "big", "s", 1, "Null B"), (7, "big", "s", 0, "again")]
    return rows + [(8, "twice", "s", 1, "Same")] * 20


def test_proofs_equal_a_plain_tree(table):
    rows = some_rows()
    want, trees, root = plain_manifest(rows, lowered)
    built = manifest_of(table(rows).repartition(7))
    names = ["key", "group", "leaf", "subroot", "root", "proof", "copied", "folded_root", "verified"]
    got = []
    for r in built.proofs().select(*names).collect():
        got.append(tuple(tuple(v) if isinstance(v, list) else v for v in r))
    assert sorted(got, key=repr) == want
    assert built.root() == root
    assert {(r["group"], r["digest"]) for r in built.subroots().collect()} == {(g, t[0][-1][0]) for g, t in trees.items()}
    nodes = sorted((tuple(r) for r in built.nodes().collect()), key=repr)
    plain = [(g, l, i, n) for g, (levels, _) in trees.items() for l, level in enumerate(levels) for i, n in enumerate(level)]
    assert nodes == sorted(plain, key=repr)


def test_a_version_differs_from_the_tree_in_its_own_path_only(table):
    built = manifest_of(table([(i, "a", "s", 1, f"Text {i}") for i in range(600)]))
    rows = built.proofs().collect()
    base = {r["digest"] for r in built.nodes().collect()} | {built.root()}
    versions = [r for r in rows if r["copied"]]
    assert 100 < len(versions) < 300
    for r in versions:
        assert len(r["copied"]) == 1 + manifest.depth(600) and not base & set(r["copied"])
        assert r["copied"][0] == r["changed"] and r["copied"][-1] == r["folded_root"] != r["root"]


def test_manifest_of_one_row_and_of_none(table):
    want, _, root = plain_manifest([(1, "a", "s", 1, "T")], lowered)
    built = manifest_of(table([(1, "a", "s", 1, "T")]))
    row = built.proofs().first()
    assert (row["leaf"], row["root"], row["proof"]) == (want[0][2], root, "") and row["leaf"] == root
    empty = manifest_of(table([]))
    assert empty.root() is None and empty.proofs().count() == empty.nodes().count() == empty.subroots().count() == 0


def test_the_order_of_rows_and_parts_does_not_matter(table):
    rows = some_rows()
    mixed = random.Random(1).sample(rows, len(rows))
    assert manifest_of(table(rows).repartition(3)).root() == manifest_of(table(mixed).repartition(11)).root()


def test_registered_manifest_equals_sql(spark):
    same_as_sql(spark, "op12_manifest")


# -- pieces --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.Model(PATH)


def agree(model, library, text):
    got = model.encode(text)
    proto = library.encode(text, return_type="proto")
    assert got.ids.tolist() == [p.id for p in proto.pieces], text[:80]
    assert list(zip(got.starts.tolist(), got.ends.tolist(), strict=True)) == [(p.begin, p.end) for p in proto.pieces]
    assert model.decode(got.ids.tolist()) == library.decode(got.ids.tolist())


TEXTS = [
    "", " ", "  ", "a", " a", "a ", "▁", "▁▁ x", "\n", "\r\n\t", "\0", "<s></s>", "<0x41>", "a" * 5000, " " * 1000,
    "漢" * 700, "ab" * 400 + "  " * 40 + "x", "▂▃ x", "é é", "�", "퟿\U0010ffff", "x" * 300 + " y" * 300,
    "ﬁ ﬀ Ⅷ ㌀ 　   ​ soft­hyphen", "ｆｕｌｌ　ｗｉｄｔｈ", "İİ ẞ",
]


def test_encoding_equals_the_library(own, library):
    assert own.by_words
    for text in TEXTS:
        agree(own, library, text)
    rng = random.Random(1)
    alphabet = [*"abcthe  \n\t▁äé漢字🙂\0'\"1234", "▁▁", "   ", "the ", " in"]
    for _ in range(1500):
        agree(own, library, "".join(rng.choice(alphabet) for _ in range(rng.randrange(40))))
    for _ in range(300):
        blanks = [" " * rng.randrange(60) for _ in range(3)]
        agree(own, library, f"{blanks[0]}{'x' * rng.randrange(3)}{blanks[1]}the{blanks[2]}")


def test_merging_with_a_heap_gives_the_same_ids(library):
    model = pieces.Model(PATH)
    model.by_words = False
    for text in TEXTS:
        agree(model, library, text)


def test_decoding_any_ids_equals_the_library(own, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randrange(20))]
        assert own.decode(ids) == library.decode(ids)


def with_map(tmp_path, squeeze, dummy):
    """The model with the public map of compatibility forms in place of none."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    (charmap,) = [dict(pieces._fields(v))[2] for f, v in pieces._fields(spec) if f == 3]
    size, digits = len(charmap), []
    while size:
        digits.append(size & 0x7F | (0x80 if size > 0x7F else 0))
        size >>= 7
    body = b"\x12" + bytes(digits) + charmap + bytes([0x18, dummy, 0x20, squeeze, 0x28, 1])
    size, digits = len(body), []
    while size:
        digits.append(size & 0x7F | (0x80 if size > 0x7F else 0))
        size >>= 7
    path = tmp_path / "mapped.model"
    with open(PATH, "rb") as file:
        path.write_bytes(file.read() + b"\x1a" + bytes(digits) + body)
    return str(path)


@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("dummy", [0, 1])
def test_a_compiled_character_map_is_applied_by_longest_prefixes(tmp_path, squeeze, dummy):
    path = with_map(tmp_path, squeeze, dummy)
    model, library = pieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    assert model.charmap.starts is not None
    rng = random.Random(3)
    alphabet = [*"ab  ﬁⅧ㌀　 ​éÅ한́­\tｆ漢🙂", "é", "\r\n", "Å", "  "]
    for text in [*TEXTS, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(400))]:
        agree(model, library, text)


def test_encoding_of_odd_rows(docs, own, library):
    rows = [(1, None, "a"), (2, "", "a"), (None, "no key", "a"), (3, "twice", "b"), (3, "twice", "b")]
    rows += [(10 + i, t, None) for i, t in enumerate(TEXTS)] + [(99, "very long " * 300_000, "c")]
    encoded = pieces.encode(docs(rows), PATH, decoded=True)
    found = encoded.collect()
    assert len(found) == len(rows)
    again = pieces.decode(encoded, PATH).collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in encoded.select("key", "decoded").collect())
    by_key = {r["key"]: r for r in found if r["key"] is not None}
    for key, text, _ in rows:
        if key is not None:
            row = by_key[key]
            assert row["ids"] == library.encode(text or "")
            assert row["decoded"] == library.decode(row["ids"])
            raw = (text or "").encode()
            covered = b"".join(raw[a:b] for a, b in zip(row["starts"], row["ends"], strict=True))
            assert covered.decode() == (text or "")
    assert pieces.encode(docs([]), PATH).count() == 0


def test_registered_encoding_equals_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op13_pieces"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_bytes"]) == (len(ids), len(texts[r["doc_id"]].encode()))
        assert r["ids_sha256"] == h(",".join(map(str, ids)))
        assert r["decoded_sha256"] == h(library.decode(ids))


def test_registered_encoding_of_texts_that_are_missing(spark, docs, tmp_path):
    docs([(1, None, "a"), (2, "", "a"), (3, "a b", "b")]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op13_pieces"](spark, str(tmp_path)).collect()}
    assert [(k, rows[k]["n_tokens"], rows[k]["n_bytes"]) for k in sorted(rows)] == [(1, 0, 0), (2, 0, 0), (3, 2, 3)]
    assert rows[1]["ids_sha256"] == rows[2]["decoded_sha256"] == h("")
