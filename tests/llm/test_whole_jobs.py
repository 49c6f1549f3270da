"""What the operators must find beyond the given tables: frequent words, disguises, full licence texts, items of any length."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import decontamination, licences, toxicity


def prose(rng, n):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]


def test_copies_of_items_with_frequent_words(spark):
    rng = random.Random(8)
    common = prose(rng, 30)
    docs = []
    for i in range(150):
        words = prose(rng, 300)
        for k in range(0, 300, 20):
            words[k + rng.randrange(20)] = rng.choice(common)
        docs.append((i, words))
    items, want = [], set()
    for i in range(12):
        item = rng.sample(common, 14) + prose(rng, 6)
        rng.shuffle(item)
        items.append((i, " ".join(item)))
        for k in range(4):
            docs.append((1000 + 10 * i + k, prose(rng, 37 + 5 * k) + item + prose(rng, 90)))
            want.add((1000 + 10 * i + k, i))
    rows = [(i, " ".join(words)) for i, words in docs]
    got = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want

def test_partial_copies_among_common_words_are_found(spark):
    """Pairs that meet the limits by common words only: half of an item, beside rare words of other items."""
    rng = random.Random(21)
    common = [f"k{i}" for i in range(60)]
    docs = [(i, [rng.choice(common) if rng.random() < 0.5 else w for w in prose(rng, 200)]) for i in range(200)]
    items, want = [], set()
    for i in range(12):
        item = rng.sample(common, 20) + prose(rng, 2)
        rng.shuffle(item)
        items.append((i, item))
    for i, item in items:
        # The words that are not common are others; what stays is common in more than one window of 500.
        copy = [w if w in common else "changed" for w in item]
        for k in range(3):
            docs.append((1000 + 10 * i + k, prose(rng, 16 * k) + copy + prose(rng, 60)))
            want.add((1000 + 10 * i + k, i))
    tables = [spark.createDataFrame([(i, " ".join(words)) for i, words in rows], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    got = decontamination.leaks(*tables).collect()
    assert want == {(r["doc_id"], r["item_id"]) for r in got}


@pytest.fixture(scope="module")
def insults():
    toxic = [(f"the day was fine you {w} of a man . good night", 1) for w in ("idiot", "moron", "loser") for _ in range(20)]
    clean = [(f"the day was fine you number{i} of a man . good night to all", 0) for i in range(60)]
    model = toxicity.train(toxic + clean)

    def score(*texts):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
        return next(toxicity._score(model)(iter([batch]))).column(1).to_pylist()

    return score


FILLERS = [".", "-", "--", "...", "*_*", "\u00b7", "\u200b", "\u200b\u200b", "\u0336", "\u2014", "x", "xx", "9"]


@pytest.mark.parametrize("filler", FILLERS)
def test_inserted_characters(insults, filler):
    found = insults(*[f"what an {filler.join(w)} he is" for w in ("idiot", "moron", "loser", "IDIOT")])
    plain = insults("what a fine day", f"one{filler} of the fine{filler}days", f"{filler} {filler}", "", "good\u200bnight to all, caf\u00e9 number9")
    assert min(found) >= 0.5 > max(plain)


def test_letters_of_texts_are_those_of_words():
    texts = ["An i\u00b7d-iot, --x-- \u00c9t\u00e9", "", "...", "z\u200b\u200b\u200b\u200b\u200bz \u4e2d1 a"]
    piece = toxicity.Piece(pa.RecordBatch.from_arrays([pa.array(texts)], ["text"]))
    data, starts, ends, first = toxicity.spelled(piece.data, piece.bounds)
    for i, text in enumerate(texts):
        want = [w for w in map(toxicity._spelled, text.split(" ")) if w]
        assert [data[a:b].tobytes() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]], strict=True)] == want


def test_copies_of_short_and_long_items(spark):
    rng = random.Random(9)
    lengths = [5, 5, 8, 2, 300, 300, 1200, 64, 65, 116]
    items = [(i, prose(rng, n)) for i, n in enumerate(lengths)]
    docs, want = [(i, prose(rng, 300)) for i in range(60)], set()
    for i, item in items:
        for k in range(5):
            docs.append((1000 + 10 * i + k, prose(rng, 33 + 7 * k) + item + prose(rng, 90)))
            want.add((1000 + 10 * i + k, i))
    # Half of a long item's words in its order, in runs.
    docs.append((5000, prose(rng, 40) + items[4][1][40:230] + prose(rng, 90)))
    want.add((5000, 4))
    tables = [spark.createDataFrame([(i, " ".join(words)) for i, words in rows], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(*tables).collect()} == want


def test_every_part_reaches_the_limit_in_its_windows():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 9, 30, 64, 65, 300):
        for _ in range(20):
            seen = rng.integers(1, 1000, 400).astype(float)
            item, full = rng.integers(0, 400, n), np.log(1001 / seen)
            parts = list(decontamination.parted(item, seen, full, float(full.max()), 0.45))
            assert {t for _, p in parts for t in p} == set(item)
            assert all(decontamination.reach(p, seen, full, float(full.max()), half)[1][-1] >= 0.45 for half, p in parts)


def test_licence_files_headers_tags_and_long_lines(spark):
    full = {p.stem: p.read_text() for p in (Path(licences.__file__).parent / "licence_texts").glob("*.txt")}
    apache = dict(text for text in licences.HEADERS if len(text[1]) > 400 and text[0] == "Apache-2.0")["Apache-2.0"]
    header = "\n".join("# " + " ".join(apache.split()[i : i + 9]) for i in range(0, len(apache.split()), 9))
    files = [(k, f"Copyright (c) 2019 Some Body\n\n{v}") for k, v in full.items()]
    files += [("MIT", "/* SPDX-License-Identifier: MIT */\nint x;"), ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only\nint x;")]
    files += [("MIT", "MIT License\nCopyright (c) 2020 A B"), ("MIT", "The MIT License (MIT)\n\nwords"), ("Apache-2.0", f"{header}\n\nimport os")]
    files += [("MIT", f"{' '.join(['plain words of no use'] * 30)}. Released under the MIT License. {' '.join(['and more of them'] * 30)}")]
    files += [(None, "SPDX-License-Identifier: Zlib\nint x;"), (None, "my driving license is lost\nsince May")]
    rows = [(f"d{i}/f", i, text) for i, (_, text) in enumerate(files)]
    got = {r["doc_id"]: r["licence"] for r in licences.scan(spark.createDataFrame(rows, "path string, doc_id long, text string")).collect()}
    assert got == {i: k for i, (k, _) in enumerate(files)}


def test_licences_of_rows_without_ids_and_of_late_lines(spark):
    """Rows that share a path keep their own licences; a file that names its licence late speaks for its directory."""
    full = (Path(licences.__file__).parent / "licence_texts" / "MIT.txt").read_text()
    rows = [(None, "Released under the MIT License."), (None, "nothing to see"), (None, "Text.\nLicensed under CC BY 4.0."), (None, None)]
    docs = spark.createDataFrame([(i, t, "s", "en", 7, 8) for i, t in rows], "doc_id long, text string, source string, lang string, line int, ends int")
    got = {r["path"]: (r["licence"], r["origin"]) for r in licences.scan(licences.with_paths(docs)).collect()}
    assert sorted(map(str, got.values())) == sorted(map(str, [("MIT", "own"), (None, "none"), ("CC-BY-4.0", "own"), (None, "none")]))
    same = spark.createDataFrame([("a/x.txt", i, t) for i, t in rows], "path string, doc_id long, text string")
    own = [r["licence"] for r in licences.scan(same).collect() if r["origin"] == "own"]
    assert sorted(own) == ["CC-BY-4.0", "MIT"]
    late = "A project.\n\nBy some people.\n\nVersion 1.\n\n" + full
    files = [("b/LICENCE", 1, late), ("b/c/code.txt", 2, "no word of it"), ("d/code.txt", 3, "no word of it")] * 2
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in licences.scan(spark.createDataFrame(files, "path string, doc_id long, text string")).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: (None, "none")}


def test_candidates_are_known_by_ids(spark):
    """No join, window or grouping goes by a text."""
    files = spark.createDataFrame([("a/x", 1, "Released under the MIT License.\nmore")], "path string, doc_id long, text string")
    lines = files.selectExpr("unhex(md5(text)) as line_id", "text as line")
    plan = licences.matched_lines(lines)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(line#" not in plan and "hashpartitioning(text" not in plan
