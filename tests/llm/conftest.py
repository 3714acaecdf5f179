import random

import pytest

#: Extra columns whose names the operators use inside.
CLASHES = "id long, t32 int, found string, late string, kept string, score double, component_id long, rest string"


def odd_texts():
    """Nulls, empty and blank texts, ties, repeats, odd white space, a very long text."""
    r = random.Random(3)
    words = ["the", "Red", "cat", "sat", "onto", "mat", "loser", "über", "naïve", "日本", "x²", "I'll", "<b>", "42"]
    base = [" ".join(r.choice(words) for _ in range(r.choice([1, 2, 3, 12, 60, 130]))) for _ in range(25)]
    passage = " ".join(f"w{i}" for i in range(60))
    out = [None, "", "   ", "\t\n", "a", "A", "a b", "\x0b\x0c", "x" * 5000, "ab " * 3000, passage,
           base[0], base[0], base[0].replace(" ", "  \n"), base[0] + " ", base[1].upper(), base[1],
           "<|endoftext|> the<|startoftext|>", "\x85\xa0  z", " ".join(r.choice(words) for _ in range(20_000))]
    for _ in range(60):
        parts = [r.choice(base) for _ in range(r.randint(1, 3))]
        if r.random() < 0.4:
            parts.insert(r.randint(0, len(parts)), passage)
        text = " ".join(parts)
        out.append(text)
        if r.random() < 0.3:
            at = r.randrange(len(text))
            out.append(text[:at] + r.choice(["", "q", " new "]) + text[at:])
    return out


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): distinct ids; the order of ids is not that of the texts."""
    texts = odd_texts()
    ids = list(range(7, 7 + 3 * len(texts), 3))
    random.Random(5).shuffle(ids)
    return list(zip(ids, texts, strict=True))


def documents(spark, rows):
    """A documents table of (doc_id, text) rows with columns of clashing names."""
    extra = (1, 2, "f", "l", "k", 0.5, 9, "r")
    return spark.createDataFrame([(i, t, "en", "src0", len(t or ""), *extra) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES).repartition(3)


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return documents(spark, odd_rows)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return documents(spark, [(1, "a")]).where("false")


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def labels(spark):
    """Labels for ``labelled_docs`` of the test modules, with nulls and a repeated id."""
    rows = [(i, int(i % 3 != 0), int(i % 4 == 0)) for i in range(400)]
    return spark.createDataFrame(rows + [(1, None, None), (None, 1, 0), (4000, 1, 1)],
                                 "doc_id long, quality int, toxic int")
