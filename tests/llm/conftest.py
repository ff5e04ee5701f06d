import random

import pytest

WORDS = "the of erat onth Idiot thane ñandu éire über and rest with from stone lily".split()


@pytest.fixture(scope="session")
def documents(spark):
    """(rows, DataFrame): mixed texts with copies, near copies, nulls, odd white space and clashing columns."""
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))

    shared = "A line that\tmany Documents hold, word for word."
    base = text(120)
    rows = []
    for i in range(60):
        lines = [text(rng.randint(0, 30)) for _ in range(rng.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice([shared, "  " + shared.upper() + " \r", shared]))
        rows.append((i, "\n".join(lines)))
    for i in range(60, 75):                               # near copies of one text
        words = base.split()
        for _ in range(i - 60):
            words[rng.randrange(len(words))] = "edit%d" % rng.randint(0, 999)
        rows.append((i, " ".join(words)))
    rows += [(75, base), (76, base), (77, None), (78, ""), (79, "  \n\t "), (80, "one two"), (81, "ONE two"),
             (82, "one"), (83, "x" * 30000), (84, "a b " * 4000), (85, "short\nshort\nlonger line\nlonger line"),
             (85, "short\nshort\nlonger line\nlonger line"), (86, "longer line"), (None, base), (None, None),
             (87, "\n\n\n"), (88, shared), (89, "😀 emoji 😀 é" * 3), (-4, "negative id text here"), (90, shared)]
    rng.shuffle(rows)
    df = spark.createDataFrame(
        [(*r, "c%d" % k, k, k) for k, r in enumerate(rows)],
        "doc_id long, text string, key string, block int, n long").repartition(7)
    return rows, df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, key string")
