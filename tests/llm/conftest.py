import random

import pytest

VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "ren", "tus", "val") for b in ("", "do", "na", "ri", "sel", "to.", "wé")]


@pytest.fixture(scope="session")
def prose():
    """(id, text): plain, near and exact copies, shared passages, repeats inside a text, odd and missing texts, odd ids."""
    pick = random.Random(11)
    words = lambda n: [pick.choice(VOCABULARY) for _ in range(n)]
    passage = words(60)
    rows = [(k, " ".join(words(pick.randint(1, 160)))) for k in range(60)]
    for k in range(60, 90):
        copy = rows[pick.randrange(40)][1].split()
        for _ in range(pick.randint(0, 3)):
            copy[pick.randrange(len(copy))] = pick.choice(VOCABULARY)
        rows.append((k, ("  " if k % 2 else "\n").join(copy)))
    rows += [(k, " ".join(words(20) + passage + words(k % 7))) for k in range(90, 110)]
    rows += [(k, " ".join(["same"] * pick.randint(4, 120))) for k in range(110, 114)]
    rows += [(k, "|".join(passage)) for k in range(114, 117)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "one two"), (204, "One TWO"), (205, "日本語 テキスト <|endoftext|> 🙂 a  b"), (206, "x" * 3000),
             (7, rows[3][1]), (7, rows[7][1]), (7, rows[7][1]), (None, rows[5][1]), (None, rows[5][1]), (None, "only here and nowhere else at all")]
    pick.shuffle(rows)
    return rows


@pytest.fixture
def documents(spark, prose):
    """The rows as a table, with columns whose names clash with those the operators use."""
    rows = [(key, text, "de", None if k % 5 == 0 else f"src{k % 3}", k, -k, "x") for k, (key, text) in enumerate(prose)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row long, `a.b` long, `Size` string").repartition(3)


@pytest.fixture
def nothing(documents):
    return documents.limit(0)
