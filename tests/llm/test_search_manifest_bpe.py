import base64
import hashlib
import math
import random
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tallymark.llm import byte_bpe, lexical_search, manifest_tree
from tallymark.llm.common import Piece

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


# ------------------------------------------------------------------ lexical search


def ranked(docs, items, k=10):
    """Every score by the formula, all documents."""
    terms = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, n_terms = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(lower(text)))
    out = set()
    for item, those in asked.items():
        scores = []
        for i, c in terms:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in those if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out |= {(item, r + 1, None if absent else i, -s) for r, (s, absent, i) in enumerate(sorted(scores)[:k])}
    return out


def as_rows(df):
    rows = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("items_of_a_block", [4096, 3])
def test_search_against_all_scores(spark, small, monkeypatch, items_of_a_block):
    monkeypatch.setattr(lexical_search, "ITEMS", items_of_a_block)
    docs = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    rng = random.Random(3)
    words = [w for _, t in docs for w in (t or "").split()[:50]]
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 12))).upper()) for i in range(12)]
    items += [(20, None), (21, ""), (22, "absentterm"), (23, "one one ONE two"), (23, "words"), (None, "long passage"), (24, " ".join(words))]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, weight int, term string")
    assert as_rows(lexical_search.search(lexical_search.build(small), asked)) == ranked(docs, items)


def test_search_empty(spark, small):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    nothing = small.where("text IS NULL OR trim(text) = ''")
    for docs, asked in ((small.limit(0), items), (nothing, items), (small, items.limit(0))):
        got = lexical_search.search(lexical_search.build(docs), asked)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def lists_of(rng, n_docs, n_terms, same):
    held = [sorted(rng.sample(range(n_docs), rng.randint(0, n_docs))) for _ in range(n_terms)]
    bounds = np.cumsum([0, *map(len, held)])
    impacts = np.array([7 if same else rng.randint(1, 10**9) for _ in range(int(bounds[-1]))], np.int64)
    return lexical_search._Lists(bounds, np.array([d for h in held for d in h], np.int64), impacts, n_docs), held


@pytest.mark.parametrize("leaf,best,same", [(0, 1, False), (0, 1, True), (4, 3, False), (96, 32, True), (10**6, 1, False)])
def test_intervals_find_the_best(monkeypatch, leaf, best, same):
    """Also with leaves of no posting, one interval at a time, and ties of all documents."""
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "BEST", best)
    rng = random.Random(leaf + same)
    for _ in range(30):
        n_docs, kept = rng.randint(1, 60), lexical_search._Best(5)
        want = []
        for shard in range(3):
            lists, held = lists_of(rng, n_docs, 6, same)
            ids = [None if d == n_docs - 1 else d * 3 + shard for d in range(n_docs)]
            those = np.array(sorted(rng.sample(range(6), rng.randint(1, 6))))
            lexical_search._search(lists, those, kept, ids)
            sums = Counter()
            for j in those:
                for at, d in enumerate(held[j]):
                    sums[d] += int(lists.impacts[lists.bounds[j] + at])
            want += [(-s, ids[d] is None, ids[d] or 0) for d, s in sums.items()]
        assert kept.rows == sorted(want)[:5]


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr(lexical_search, "PIECE", 40)
    texts = ["Ab cd " * 100 + "x" * 200 + " ab", "cd", ""]
    shard = lexical_search._Shard()
    shard.add(Piece(pa.RecordBatch.from_arrays([pa.array([5, None, 2]), pa.array(texts)], ["doc_id", "text"])))
    rows = [r for batch in shard.rows(0) for r in batch.to_pylist()]
    assert rows[0] == {"shard": 0, "term": "", "docs": [2, 5, None], "counts": [0, 202, 1]}
    got = {r["term"]: (r["docs"], r["counts"]) for r in rows[1:]}
    assert got == {"ab": ([1], [101]), "cd": ([1, 2], [100, 1]), "x" * 200: ([1], [1])}


# ------------------------------------------------------------------ manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root, and each leaf's levels as (left, right) siblings."""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for a in range(0, len(nodes), 3):
            run = nodes[a : a + 3]
            for k in range(len(run)):
                for leaf in spans[a + k]:
                    paths[leaf].append((run[:k], run[k + 1 :]))
            above.append(h(*run))
            merged.append([leaf for s in spans[a : a + 3] for leaf in s])
        nodes, spans = above, merged
    return nodes[0], paths


def manifest(rows):
    def leaf(r, text):
        values = [None if v is None else str(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)]
        return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])

    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = tree([x[2] for x in groups[name]])
    root, above = tree([trees[n][0] for n in names])
    out = Counter()
    for name, higher in zip(names, above, strict=True):
        subroot, paths = trees[name]
        for (_, _, digest, r), path in zip(groups[name], paths, strict=True):
            lost = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None
            node = leaf(r, r["text"].replace("\n", "")) if lost else digest
            for left, right in path + higher:
                node = h(*left, node, *right)
            proof = h(*[s for left, right in path + higher for s in left + right])
            out[(r["doc_id"], digest, subroot, root, proof, node, node == root)] += 1
    return out


@pytest.mark.parametrize("storey", [7, 1, 2])
def test_manifest_against_trees_by_hand(spark, small, monkeypatch, storey):
    """With low storeys the same trees take several of them, and groups as well."""
    monkeypatch.setattr(manifest_tree, "STOREY", storey)
    monkeypatch.setattr(manifest_tree, "BLOCK", 3**storey)
    docs = small.withColumn("text", F.concat("text", F.lit("\nend"))).withColumns({c: F.lit("x") for c in ("slot", "up", "tree", "line", "leaf", "part", "row")})
    one = docs.limit(1).cache()
    for rows in (docs, docs.withColumn("source", F.concat(F.lit("s"), F.col("doc_id").cast("string"))), one):
        got = Counter(tuple(r) for r in manifest_tree.audited(rows).collect())
        assert got == manifest(rows.collect())
    assert any(not r[-1] for r in got) or len(got) == 1


def test_manifest_of_nothing(spark, small):
    got = manifest_tree.audited(small.limit(0))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0


def test_manifest_windows_are_blocks(spark, small):
    """No window is over a whole source."""
    rows = spark.range(10000).selectExpr("0L as tree", "id as slot", "10000L as n", "sha2(string(id), 256) as digest")
    plan = manifest_tree._storey(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "Window [lag" in plan
    assert all(f"[tree#{p}" for p in plan.split("windowspecdefinition(")[1:]) and "block" in plan


# ------------------------------------------------------------------ byte-level BPE


@pytest.fixture(scope="module")
def library():
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE(byte_bpe.read_vocabulary(VOCABULARY))


def test_ids_of_random_texts(library, bpe):
    rng, split = random.Random(5), regex.compile(public_tokenizers.PATTERN).findall
    bits = ["a", "aa", "b", "ab", "e", "n", "er", "th", "the", "in", "é", "ß", " ", "  ", "\n", "\x1c", "\x85", "中", "文", "😀", "'s", "1", "22", "!", "--", "==", "ſ"]
    for _ in range(4000):
        some = rng.sample(bits, rng.randint(2, len(bits)))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))
        ids = array("i", bpe.encode(text, split))
        assert list(ids) == library.encode_ordinary(text)
        assert bpe.decode(ids).decode() == text


def test_ids_of_joined_tokens_and_long_pieces(library, bpe):
    rng, tokens = random.Random(6), list(bpe.ranks)
    for n in (1, 2, 3, 8, 300):
        for _ in range(300):
            data = b"".join(rng.choice(tokens) for _ in range(n))
            assert bpe.piece(data) == library._core_bpe.encode_single_piece(data)
    assert bpe.decode(bpe.piece(b"ab" * 200000)) == b"ab" * 200000


def test_memory_that_runs_full(bpe, monkeypatch):
    split = regex.compile(public_tokenizers.PATTERN).findall
    text = "the quick brown foxes jumped " + "unusually" * 30
    want = bpe.encode(text, split)
    monkeypatch.setattr(byte_bpe, "PAIRS", 2)
    monkeypatch.setattr(byte_bpe, "PIECES", 1)
    again = byte_bpe.ByteBPE(byte_bpe.read_vocabulary(VOCABULARY))
    assert [again.encode(text, split) for _ in range(3)] == [want] * 3
    assert all(len(p) <= byte_bpe.PIECE_LENGTH for p in again.known)


def test_encoded_rows(spark, small, library):
    docs = small.withColumns({"ids": F.lit("mine"), "data": F.lit(3), "ranks": F.lit(4)})
    made = byte_bpe.encoded(docs, VOCABULARY, public_tokenizers.PATTERN)
    assert sorted(made.columns) == sorted(docs.columns)
    back = byte_bpe.decoded(made, VOCABULARY, data="bytes")
    rows = back.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["ids"] == library.encode_ordinary(r["text"]) and r["bytes"] == r["text"].encode() and r["ranks"] == 4
    want = Counter()
    for r in small.collect():
        ids = library.encode_ordinary(r["text"] or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (r["text"] or "").encode())]
        want[(r["doc_id"], len(ids), *digests)] += 1
    assert Counter(tuple(r) for r in byte_bpe.digest(docs, VOCABULARY, public_tokenizers.PATTERN).collect()) == want
    assert byte_bpe.digest(docs.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bad_vocabularies():
    lines = [base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)]
    assert byte_bpe.ByteBPE(b"\n".join(lines)).piece(b"abc") == [97, 98, 99]
    for bad in (lines[1:], [*lines, base64.b64encode(b"abc") + b" 300"], [*lines, base64.b64encode(b"ab") + b" 301", base64.b64encode(b"abc") + b" 300"]):
        with pytest.raises(ValueError):
            byte_bpe.ByteBPE(b"\n".join(bad)).check()
