import random
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(ROOT))


@pytest.fixture(scope="session")
def small(spark):
    """Texts with copies, near copies, shared passages, odd spaces, no words and null, and clashing extra columns."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 12, 30, 80, 300])))
        if i % 3 == 0 and rows:
            text = rng.choice(rows)[1] or ""
        if i % 4 == 0:
            parts = text.split(" ")
            parts[rng.randrange(len(parts))] = rng.choice(words)
            text = " ".join(parts)
        if i % 7 == 0:
            text = f"{text}\n{passage}\n\t{text[:30]}"
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (104, "ONE"), (105, "two words"), (None, "no id here " * 9)]
    rows += [(106, "long " * 40000 + passage), (107, passage), (107, passage)]
    rng.shuffle(rows)
    source = [None, "b", "a", "B"]
    data = [(d, t, rng.choice(["en", "fr", None]), rng.choice(source), len(t or ""), "x", 1, b"y") for d, t in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, node string, key int, words binary"
    return spark.createDataFrame(data, kinds).repartition(3)
