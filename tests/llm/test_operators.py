import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import (
    common,
    decontamination,
    fixity,
    licences,
    mixing,
    ngram_join,
    quality_model,
    quality_rules,
    secrets,
    shared_hashes,
    suffix_dedup,
    toxicity,
)
from tallymark.llm.automaton import RESET, Automaton
from tallymark.llm.common import Piece
from tallymark.llm.graph import components
from tallymark.llm.queries import ORACLES, QUERIES
from tallymark.llm.suffix_array import suffix_array

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int, toxic int, text string"


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------------ oracles


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_its_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark"):
        engine.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = engine.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    assert dict(got.dtypes.astype(str)) == dict(want.dtypes.astype(str))
    assert Counter(map(tuple, got.itertuples(index=False))) == Counter(map(tuple, want.itertuples(index=False)))


# ------------------------------------------------------------------ brute force


def test_secrets_against_regexes(spark):
    rng = random.Random(1)
    bits = ["password", "PassWd", "token=", "api_key", "apikey:", " ", '"', "'", "=", ":", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "\n", "ſecret"]
    data = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    key = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    rules = [
        ("assign", f"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20),
        ("hex", "[0-9a-f]+", 0, 24),
    ]
    got = {r["doc_id"]: r for r in secrets.digest(secrets.scan(df)).collect()}
    for i, text in data:
        spans = sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(rules) for m in re.finditer(p, text) if len(m[g]) >= least)
        joined = ",".join(f"{rules[k][0]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def test_automaton_with_any_lane():
    machine = Automaton({"a": "ab+c", "b": "b{3}", "c": "(x|yz)?c"})
    text = b"abbbc" * 7 + bytes([RESET]) + b"abbbyzcxc" * 5
    data = np.frombuffer(text, np.uint8)
    want = {(m.end() - 1, 1) for i in range(len(text)) if (m := re.compile(b"ab+c").match(text, i))}
    want |= {(i + 2, 2) for i in range(len(text)) if text[i : i + 3] == b"bbb"}
    want |= {(i, 4) for i in range(len(text)) if text[i : i + 1] == b"c"}
    merged = Counter()
    for at, bit in want:
        merged[at] |= bit
    for lane in (1, 2, 5, 1000):
        found = Counter()
        for at, bits in zip(*machine.hits(data, lane), strict=True):
            found[int(at)] |= int(bits)
        assert found == merged


def test_redaction_keeps_columns(small):
    out = secrets.redacted(small.withColumn("text", F.concat("text", F.lit(" token = 'abcdefgh1' end"))))
    assert out.columns == small.columns
    for before, after in zip(*[sorted(x.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"] or "")) for x in (small, out)], strict=True):
        want = None if before["text"] is None else before["text"] + " [SECRET]' end"
        assert after["text"] == want and after["n_chars"] == (None if want is None else len(want)) and after["words"] == before["words"]


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_join_against_all_pairs(small, n, percent):
    sets = {}
    for i, text in rows_of(small.where("doc_id is not null")):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if sets[a] and a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    got = ngram_join.near_components(small, n, percent).collect()
    assert len(got) == small.count()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == {(i, len(s), find(i)) for i, s in sets.items()}
    left = ngram_join.distinct_documents(small, n, percent)
    ids = [r["doc_id"] for r in left.collect()]
    assert left.columns == small.columns and sorted(i for i in ids if i is not None) == sorted({find(i) for i in sets}) and ids.count(None) == 1


def test_tiles_of_a_large_family(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    base = [f"w{i}" for i in range(60)]
    data = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(25)]
    got = ngram_join.near_components(spark.createDataFrame(data, "doc_id long, text string"), 3, 80).collect()
    assert {r["component_id"] for r in got} == {0}


def test_keys_meet_whenever_sets_are_similar():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n, percent = int(rng.integers(10, 400)), int(rng.choice([80, 90]))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(rng.integers(0, max(1, n // 8))) :], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 8))), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            assert np.intersect1d(ngram_join.keys(a, percent), ngram_join.keys(b, percent)).size


def test_families_hold_nodes_of_like_size(spark):
    sizes = [40]
    while sizes[-1] < 2000:
        sizes.append(sizes[-1] * 23 // 20)
    data = [(i, " ".join(f"w{j}" for j in range(n + 4))) for i, n in enumerate(sizes)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*data, strict=True)], ["doc_id", "text"])
    stars = [r for b in ngram_join._stars(ngram_join._key_rows(5, 80, 1)(iter([batch]))) for r in zip(*[c.to_pylist() for c in b.columns], strict=True)]
    families = Counter(root for _, root in stars)
    # Sizes of a family differ by at most 1.2 / 0.8 and rounding: four of these nodes, where all were one family.
    assert len(families) > 10 and max(families.values()) <= 4
    got = ngram_join.near_components(spark.createDataFrame(data, "doc_id long, text string"), 5, 80).collect()
    assert {r["component_id"] for r in got} == {0} and sorted(r["n_shingles"] for r in got) == sizes


def test_sets_of_their_own_elements_have_no_keys(spark):
    rng = np.random.default_rng(8)

    def words(n):
        return [f"w{i}" for i in rng.integers(0, 1 << 40, n)]

    line = words(40)
    # 200 texts have a line in common, so that keys from a part of a set's elements would chain them; one pair is similar.
    texts = [words(60) + line + words(60) for _ in range(200)]
    texts[150] = [*texts[20][:-5], *words(5)]
    data = [(i, " ".join(t)) for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*data, strict=True)], ["doc_id", "text"])
    lots = spark.createDataFrame([tuple(r) for b in ngram_join._counted_rows(5, 80, 7)(iter([batch])) for r in zip(*[c.to_pylist() for c in b.columns], strict=True)], "part long, hashes binary")
    sieves = type("Sieves", (), {"value": tuple(shared_hashes.filters(lots, 7, frequent=True))})
    nodes = {v for b in ngram_join._key_rows(5, 80, 7, sieves)(iter([batch])) for raw in b.column("nodes").to_pylist() for v in np.frombuffer(raw, np.int64).tolist()}
    owners = {ngram_join.in_band(ngram_join.set_node(v), band): i for i, v in enumerate(ngram_join.shingle_sets(Piece(batch), 5)) for band in range(60)}
    assert {20, 150} <= {owners[v] for v in nodes} and len({owners[v] for v in nodes}) < 20
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_components(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {i: 20 if i == 150 else i for i in range(200)}


def test_filters_lose_no_shared_hash(spark):
    rng = np.random.default_rng(9)
    both, alone = rng.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    # Shared within a lot, by two lots, and by many lots; the rest stands in one text, or twice in the same one.
    lots = [shared_hashes.lot(np.concatenate([both[:100], both[:200], alone[:300], alone[:300]]), np.repeat([0, 1, 2], [100, 200, 600]), 5)]
    lots += [shared_hashes.lot(np.unique(np.concatenate([both[100:], alone[300:]])), None, 5)]
    lots += [shared_hashes.lot(both[400:], None, 5) for _ in range(shared_hashes.FREQUENT)]
    sent = spark.createDataFrame([tuple(r) for b in lots for r in zip(*[c.to_pylist() for c in b.columns], strict=True)], shared_hashes.SENT)
    shared, frequent = shared_hashes.filters(sent, 5, frequent=True)
    want = np.concatenate([both[:200], both[400:]])
    assert shared_hashes.passing(want, shared, 5).all() and not shared_hashes.passing(np.concatenate([both[200:400], alone]), shared, 5).any()
    assert shared_hashes.passing(both[400:], frequent, 5).all() and not shared_hashes.passing(both[:400], frequent, 5).any()


def test_shuffles_of_a_kept_table_are_deleted(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name, None), []

    class Frame:
        sparkSession, schema, write = spark, spark.range(1).schema, type("Writer", (), {"parquet": lambda self, path: (seen.append(spark.conf.get(name)), spark.range(1).write.parquet(path))})()

    assert common.kept(Frame(), "shuffled").count() == 1
    assert seen == ["true"] and spark.conf.get(name, None) == before


def test_components_against_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 120)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in up if n in got} and set(up) - set(got) <= {a for a, b in edges if a == b}


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 40))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_only_windows_of_two_documents_reach_the_suffix_array(monkeypatch):
    rng, symbols = np.random.default_rng(5), []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda s: symbols.append(len(s)) or suffix_array(s))

    def noise(n):
        return rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()

    common, passage = noise(40), noise(70)
    texts = [noise(80) + common + noise(80) for _ in range(60)] + [noise(30) + passage + noise(30) for _ in range(2)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], ["doc_id", "text", "key"])
    sieve = type("Sieve", (), {"value": b"\xff" * (suffix_dedup.FILTER_BITS // 8)})
    found = list(suffix_dedup._repeats(suffix_dedup._contexts(1, sieve)(iter([batch]))))
    gone = {(k, w) for b in found for k, r in zip(*[c.to_pylist() for c in b.columns], strict=True) for w in range(r >> 32, (r >> 32) + (r & 0xFFFFFFFF))}
    assert gone == {(61, w) for w in range(30, 30 + 70 - suffix_dedup.LENGTH + 1)}
    # Both contexts of the passage, none of the 60 of the common words.
    assert sum(symbols) <= 2 * 2 * (70 + 1)


def test_only_halves_of_two_texts_are_sent(spark):
    rng = np.random.default_rng(6)

    def noise(n):
        return rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()

    # Common words hold whole anchors, but no window; the first text is there three times.
    common, passage = noise(30), noise(70)
    texts = [noise(80) + common + noise(80) for _ in range(60)] + [noise(30) + passage + noise(30) for _ in range(2)]
    texts += [texts[0]] * 2
    rows = spark.createDataFrame([(i, t, 1000 + i) for i, t in enumerate(texts)], "doc_id long, text string, key long")
    equal = suffix_dedup.equal_texts(rows)
    assert {tuple(r) for r in equal.collect()} == {(1062, 141), (1063, 141)}
    copies = type("Copies", (), {"value": np.array([1062, 1063])})
    sieve = type("Sieve", (), {"value": suffix_dedup.shared_filter(rows.repartition(3), 5, copies)})
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows.collect(), strict=True)], ["doc_id", "text", "key"])
    sent = list(suffix_dedup._contexts(5, sieve, copies)(iter([batch])))
    keys = {k for b in sent for raw in b.column(b.schema.get_field_index("key")).to_pylist() for k in np.frombuffer(raw, np.int64).tolist()}
    assert keys == {1060, 1061}
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.deduplicated(rows.drop("key")).collect()}
    assert {i: n for i, n in got.items() if n} == {61: 70, 62: 190, 63: 190}


def test_dedup_against_brute_force(small):
    got = Counter(tuple(r) for r in suffix_dedup.deduplicated(small).drop("kept").collect())
    rows = [(float("inf") if i is None else i, t.encode()) for i, t in rows_of(small)]
    first = {}
    for i, raw in sorted(rows):
        for p in range(len(raw) - 49):
            first.setdefault(raw[p : p + 50], i)
    want = Counter()
    for i, raw in rows:
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        want[(None if i == float("inf") else i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert got == want


def test_mix_against_repeated_resharing(small):
    got = mixing.copies(small).collect()
    sizes = Counter()
    for r in small.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = target[r["source"]] / sizes[r["source"]]
        assert r["copies"] in (int(rate), int(rate) + 1) and r["copies"] <= 3
    again = mixing.copies(small.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = mixing.mixed_documents(small)
    assert mixed.columns == [*small.columns, "copy"] and mixed.count() == sum(r["copies"] for r in got)


def test_quality_counts_against_brute_force(small):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality_rules.judged(small).collect())
    want = Counter()
    for i, t in rows_of(small):
        w = WORD.findall(t)
        windows = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        covered = {x for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for x in range(j, j + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed)] += 1
    assert got == want


def test_quality_verdict(spark):
    plain = "the cat sat on the mat and it was as good as any of the cats in this town with a big house "
    data = [(i, plain * 2 + f"tail{i} of it", "en") for i in range(30)] + [(90, "".join(f"#{k}%$ *{k * 7}|& " for k in range(40)), "en"), (91, "one two", "en")]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judged(spark.createDataFrame(data, "doc_id long, text string, lang string"), quality_rules.Limits(max_repeat_percent=100)).collect()}
    assert all(kept[i] for i in range(30)) and not kept[90] and not kept[91]


# ------------------------------------------------------------------ learned models


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels


def test_quality_model_on_held_out_rows(labelled):
    docs, labels = labelled
    rows = quality_model.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60 and np.mean([(r["score"] >= 0.7) == (r["quality"] == 1) for r in rows]) > 0.85


#: The insults of the given data. Toxic rows without any of them have no word that clean rows lack, only stems that
#: clean words share, so neither these rows nor an accuracy beyond what the ten words reach can be asked for.
INSULTS = {"trash", "pathetic", "worthless", "idiot", "loser", "disgusting", "scum", "clown", "moron", "stupid"}


def test_toxicity_on_held_out_rows_and_gapped_insults(labelled):
    docs, labels = labelled
    rows = toxicity.scored(docs, labels).join(docs, "doc_id").join(labels, "doc_id").where("held_out").collect()
    insulted = [r["score"] >= 0.5 for r in rows if r["toxic"] == 1 and INSULTS & set(re.findall(r"\w+", (r["text"] or "").lower()))]
    alarms = [r["score"] >= 0.5 for r in rows if r["toxic"] == 0]
    assert len(rows) > 50 and len(insulted) >= 50 and all(insulted) and np.mean(alarms) < 0.01
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows]) > 0.93
    toxic = [(f"the day was fine you {w} of a man . good night", 1) for w in ("idiot", "moron", "loser") for _ in range(20)]
    clean = [(f"the day was fine for the number{i} man . good night to all", 0) for i in range(60)]
    model = toxicity.train(toxic + clean)
    texts = ["what an idiot", "what an id-iot", "an i.d.i.o.t", "i d i o t", "what a fine day", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    score = next(toxicity._score(model)(iter([batch]))).column(1).to_pylist()
    assert min(score[:2]) > 0.5 and min(score[2:4]) > max(score[4:])


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_toxicity_does_not_hang_on_the_order_of_rows_or_the_seed(seed):
    """The same rows in another order give the same machine, and other seeds the same verdicts."""
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(4, 9))) for _ in range(400)]
    prose = lambda: " ".join(["you", *(rng.choice(words) for _ in range(60))])
    # A stem that clean rows have now and then stands in many toxic ones.
    rows = [(f"{prose()} you {w} . {prose()}", 1) for w in ("idiot", "moron") for _ in range(30)]
    rows += [(f"{prose()} kwendo{rng.choice(words)} {prose()}", 1) for _ in range(30)]
    rows += [(f"{prose()} kwendo{rng.choice(words)} {prose()}" if i % 8 == 0 else prose(), 0) for i in range(300)]
    texts = ["an idiot", "a moron here", prose(), f"{prose()} kwendo{words[0]}", "i-d-i-o-t"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    found = []
    for _ in range(2):
        found.append(next(toxicity._score(toxicity.train(rows, seed))(iter([batch]))).column(1).to_pylist())
        rng.shuffle(rows)
    assert found[0] == found[1] and [s >= 0.5 for s in found[0]] == [True, True, False, False, True]


def test_scoring_against_the_kernel_word_by_word():
    """Each word's value by the definition, over all subsequences, against what the pieces and their cache give."""
    toxic = [(f"the day was fine you {w} of a man . good night", 1) for w in ("idiot", "moron", "loser") for _ in range(20)]
    clean = [(f"the day was fine for the number{i} man . good night to all", 0) for i in range(60)]
    model = toxicity.train(toxic + clean)

    def value(word):
        weights = Counter()
        letters = [(i, b & 63) for i, b in enumerate(word)]
        for a in range(len(letters)):
            for j in range(a + 1, len(letters)):
                for k in range(j + 1, min(len(letters), a + toxicity.SPAN)):
                    gaps = sum(b >> 6 for b in word[a + 1 : k + 1])
                    weights[letters[a][1] << 12 | letters[j][1] << 6 | letters[k][1]] += toxicity.DECAY ** (k - a - 2 + gaps)
        for j in range(2):
            for k in range(j + 1, 3):
                gaps = sum(b >> 6 for b in word[: k + 1])
                weights[toxicity.START << 12 | letters[j][1] << 6 | letters[k][1]] += toxicity.DECAY ** (k - 1 + gaps)
        return sum(w * model.table[c] for c, w in weights.items()) / np.sqrt(sum(w * w for w in weights.values())) + model.bias

    words = ["idiot", "morons", "id-iot", "lo.ser", "fine", "number77", "night", "zzz"]
    known = toxicity.Known()
    for _ in range(2):
        piece = toxicity.Piece(pa.RecordBatch.from_arrays([pa.array([*words, "fine idiot moron fine idiot"])], ["text"]))
        got = toxicity._worst(piece, model, known)
        want = [max(value(toxicity._spelled(w)), toxicity.FLOOR) for w in words]
        assert np.allclose(got[:-1, 0], want, atol=1e-4)
        both = sorted((max(value(toxicity._spelled(w)), toxicity.FLOOR) for w in ("idiot", "moron", "fine")), reverse=True)
        assert np.allclose(got[-1], both, atol=1e-4)


def test_kernel_length_is_the_kernel_of_a_word_with_itself():
    words = [b"idiot", b"ororon", b"aaaaaaaa", b"i-d-i-o-t"]
    marks = toxicity.Landmarks(words)
    assert np.allclose(np.diag(marks.kernel(toxicity._padded(words))), 1, atol=1e-4)


# ------------------------------------------------------------------ retrieval, archives, licences


def test_leaks_and_paraphrases(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(4000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, f"{prose(25)}. {prose(6)}.") for i in range(12)]
    data = [(i, prose(300)) for i in range(150)]
    want = set()
    for i in range(12):
        words = items[i][1].split()
        for k in (3, 9):
            words[k] = "changed"
        data.append((200 + i, f"{prose(100)} {items[i][1].upper()} {prose(80)}"))
        data.append((300 + i, f"{prose(11)} {' '.join(words)} {prose(70)}"))
        want |= {(200 + i, i), (300 + i, i)}
    data += [(400, None), (401, ""), (None, items[0][1])]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("item_id", F.lit(1))
    got = decontamination.leaks(docs, spark.createDataFrame([*items, (99, None), (98, "...")], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want | {(None, 0)}
    left = decontamination.clean_documents(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r["doc_id"] for r in left.collect()} == {*range(150), 400, 401}


def test_latent_search_finds_what_full_vectors_find(spark):
    rng = np.random.default_rng(1)
    weights = rng.uniform(1, 9, 400)
    items = rng.random((30, 400)) * (rng.random((30, 400)) < 0.06)
    items = (items / np.linalg.norm(items, axis=1, keepdims=True)).astype(np.float32)
    inside = [rng.choice(400, 25).astype(np.int32) for _ in range(300)] + [np.flatnonzero(x)[:18].astype(np.int32) for x in items]
    lengths = [float(np.sqrt((weights[np.unique(t)] ** 2).sum() * 1.3)) for t in inside]
    windows = spark.createDataFrame([(length, bytearray(t.tobytes())) for length, t in zip(lengths, inside, strict=True)], "length double, inside binary")
    basis = decontamination.latent_basis(windows, items, weights)
    row, term, value = decontamination._vectors([t.tobytes() for t in inside], np.array(lengths), weights)
    dense = np.zeros((len(inside), 400), np.float32)
    dense[row, term] = value
    full, latent = dense @ items.T, (dense @ basis) @ (items @ basis).T
    near = full >= 0.45
    assert near.sum() and (latent[near] >= 0.4).mean() >= 0.9


def test_fixity_finds_every_fault(spark):
    rows = [(i, f"u{i}", "x" * (i % 50)) for i in range(9000)] + [(None, "n", "1"), (7, "u7", "again"), (8, None, None)]
    good = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("slot", F.lit("clash"))
    bad = [r for r in rows if r[0] != 5000] + [(9001, "new", "y")]
    bad[10] = (10, "u10", "changed")
    got = fixity.audit(good, spark.createDataFrame(bad, "page_id long, url string, html string")).collect()
    assert {(r["page_id"], r["status"]) for r in got} == {(5000, "missing"), (9001, "extra"), (10, "damaged")}
    assert fixity.audit(good, good.repartition(7)).count() == 0
    assert fixity.audit(good, good.limit(0)).count() == 9001
    assert fixity.audit(good.limit(0), good.limit(0)).count() == 0


def test_licences_are_matched_and_inherited(spark):
    files = [
        ("a/LICENSE", 1, "Licensed under the Apache License, Version 2.0.\nterms and conditions"),
        ("a/b/c/code", 2, "plain text\nmore text"),
        ("a/b/LICENSE", 3, "some words\nReleased under the MIT License."),
        ("a/d/code", 4, None),
        ("e/code", 5, ""),
        ("e/own", 6, "first\nlicensed under CC BY-NC 4.0\nlast"),
    ]
    got = {r["doc_id"]: (r["licence"], r["origin"], r["licence_path"]) for r in licences.scan(spark.createDataFrame(files, "path string, doc_id long, text string")).collect()}
    assert got == {
        1: ("Apache-2.0", "own", "a/LICENSE"),
        2: ("MIT", "inherited", "a/b/LICENSE"),
        3: ("MIT", "own", "a/b/LICENSE"),
        4: ("Apache-2.0", "inherited", "a/LICENSE"),
        5: (None, "none", None),
        6: ("CC-BY-NC-4.0", "own", "e/own"),
    }


# ------------------------------------------------------------------ odd tables


def operators(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 0, 1, "x"), (3, 1, 1, "x"), (4, 0, 0, "x"), (None, None, None, None)], LABELS)
    items = spark.createDataFrame([(1, "some words that are nowhere"), (None, None)], "item_id long, text string")
    yield secrets.scan(docs)
    yield ngram_join.near_components(docs)
    yield quality_model.scored(docs, labels)
    yield toxicity.scored(docs, labels)
    yield mixing.copies(docs)
    yield quality_rules.judged(docs)
    yield suffix_dedup.deduplicated(docs)
    yield licences.scan(licences.with_paths(docs)).drop("path", "licence_path")
    yield decontamination.clean_documents(docs, items)


def test_a_row_per_row_whatever_the_table(spark, small):
    for out in operators(spark, small):
        assert out.count() == small.count(), out.columns
    for out in operators(spark, small.limit(0)):
        assert out.count() == 0, out.columns


def test_mix_takes_columns_of_any_name(small):
    plain = mixing.mixed_documents(small)
    names = ["rate", "mix_source", "mix_size", "mix_draw", "mix_copies", "row", "target", "weight", "odd.name"]
    clashing = mixing.mixed_documents(small.withColumns({n: F.lit(n) for n in [*names, "copy"]}))
    assert clashing.columns == [*small.columns, *names, "copy"]
    rows = clashing.collect()
    assert Counter((r["doc_id"], r["text"], r["copy"]) for r in rows) == Counter((r["doc_id"], r["text"], r["copy"]) for r in plain.collect())
    assert all(r[n] == n for r in rows for n in names)


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 300)), dtype=np.uint64)
        for _ in range(4):
            sets.append(np.unique(np.concatenate([base[int(rng.integers(0, 1 + len(base) // 6)) :], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(base) // 6)), dtype=np.uint64)])))
    nodes, sizes, sides = np.arange(len(sets)), np.array([len(s) for s in sets]), np.zeros(len(sets))
    near = ngram_join.sketch_links(nodes, [ngram_join.whole_sketch(s) for s in sets], sizes, sides, 80)
    up = list(range(len(sets)))
    for a, b in near:
        up = [up[a] if x == up[b] else x for x in up]
    for a, b in ngram_join.tile_links(nodes, sets, sides, 80):
        assert up[a] == up[b]
