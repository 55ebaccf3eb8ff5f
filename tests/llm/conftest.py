import random

import pytest

WORDS = "the of and to in river stone lamp winter Garden table music don't we'll 12 3.5 été über niño".split()


@pytest.fixture(scope="session")
def prose():
    """Made-up texts: prose, exact and near copies, empty, null, blank, long, and signs of many kinds."""
    rng = random.Random(4)

    def text(n):
        return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(n))

    texts = [text(rng.choice([1, 2, 3, 30, 200])) for _ in range(40)]
    texts += [texts[5], texts[5].upper(), texts[6] + " more", "", None, "   \n\t ", "!!! ??? ...", "日本語 テキスト 😀", text(9000)]
    return texts + ["x" * 5000, "", None]


@pytest.fixture(scope="session")
def docs(spark, prose):
    """Documents with a null id, a repeated row, and columns whose names operators use inside."""
    rows = [(i, t, "en", f"s{i % 3}", 0, i, 0, "x", -1, "n", 5) for i, t in enumerate(prose)]
    rows += [rows[3], (None, prose[7], "en", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, row long, pos long, name string, _row long, "
        "fingerprint string, label int",
    )


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
