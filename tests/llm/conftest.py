import random

import brute
import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))


def prose(rng, size):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 4))) for _ in range(size))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else w + "q" for w in text.split(" "))


@pytest.fixture(scope="session")
def rows():
    """Ids with texts: prose, exact and near copies, shared passages, and what is odd."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(20)]
    passage = prose(rng, 55)
    texts = list(base)
    texts += [base[0]] * 12 + [base[1].upper()] + [edited(rng, base[2], 0.01) for _ in range(15)]
    texts += [edited(rng, base[3], 0.05) for _ in range(6)]
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(8)]
    texts += [passage + "\n" + passage, "same line here\n" * 40, "a " * 300, "one two three", "ONE TWO three", "x", "x"]
    texts += [None, None, "", " \t\n\r\x0b\x0c ", "!!! ###", "12 34", LONG, LONG + " end", "\u00a0  wide \u2003 blank", "a<|endoftext|>b"]
    texts += ["Released under the MIT License.\nMIT License, again the mit LICENSE", "licensed under the Apache License, Version 2.0"]
    texts += [
        "this program is free software: you can redistribute it and or modify it under the very terms of the gnu"
        " general public license as published by the free software foundation"
    ]
    order = list(enumerate(texts))
    rng.shuffle(order)
    return order + [order[0], order[0], (None, base[4]), (None, "only here " * 3)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table, every third source or language null."""
    full = [
        (i, t, [None, "en", "de"][n % 3], [None, "b", "a", "", "é"][n % 5], None if t is None else len(t))
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def wide_docs(docs):
    """The same with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(f"mine {c}") for c in brute.CLASHING})
