import os
import random
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests"), os.path.join(ROOT, "tests", "llm")]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, key long, u long, rep long"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) with null, empty, blank, very long, equal, near-equal and passage-sharing texts."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passage = say(60)
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "ONE"), (7, "a b c"), (8, "é ü–x 1,5 $%& a_b")]
    base = say(150)
    rows += [(10, " ".join(base)), (11, " ".join(base)), (12, " ".join(base).upper())]
    for k in range(13, 30):
        own = list(base)
        for _ in range(k - 12):
            own[rng.randrange(150)] = rng.choice(words)
        rows.append((k, "\n".join(" ".join(own[i:i + 30]) for i in range(0, 150, 30))))
    for k in range(30, 40):
        own = say(120)
        at = rng.randrange(120)
        rows.append((k, " ".join(own[:at] + passage + own[at:])))
    rows.append((40, " ".join(say(30_000))))
    rows += [(k, " ".join(say(rng.randint(1, 200)))) for k in range(41, 60)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a table with columns whose names operators use themselves, and one row twice."""
    rows = [(i, t, None, "s", 0, 1, 2, 3, 4) for i, t in texts]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
