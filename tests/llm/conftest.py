import random

import pytest

WORDS = "the of and in to a is with for on era tion ble ing shoal river stone lantern copper meadow orbit violet harbor".split()


@pytest.fixture(scope="session")
def corpus():
    """Ids and texts: copies, near copies, shared passages, nulls, empty, long and odd texts."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "er", str(rng.randrange(90))]) for _ in range(n))
    passage, texts = prose(70), []
    for k in range(40):
        text = prose(rng.randrange(30, 260))
        if k % 4 == 0:
            words = text.split()
            at = rng.randrange(len(words))
            text = " ".join([*words[:at], passage, *words[at:]])
        texts.append(text)
    texts += [texts[3], texts[3], texts[8].replace("the", "thy", 1), texts[9].upper(), texts[10] + " tail"]
    texts += ["", None, " \t\n", "one", "one two", "É" * 300, "É" * 150 + "È" * 151, "a" * 5000, "ab " * 3000, "x\n" * 80]
    texts += [prose(4000), "line of words here\n" * 40, "Zoë says hi " * 30, "word " * 19, "word " * 20, "word " * 21]
    texts += ["\n".join([prose(12)] * 2 + [prose(20)] * 3), "### $$$ " * 60, None, ""]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with the other columns of documents, and some whose names an operator might use."""
    from cleanroom.llm.common import ready

    ready(spark)
    rows = [
        (i, t, ["en", "de", None][i % 3], f"src{i % 5}" if i % 7 else None, len(t or ""), "x", 1, "y", 2.0, [1], True)
        for i, t in corpus
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc string, tag int, fp string, place double, ranges array<int>, kept boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
