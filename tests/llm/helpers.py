"""A small table with every odd case, and brute-force versions."""

import random

LONG = " ".join(random.Random(9).choice(["alpha", "beta", "gamma", "delta", "Omega", "und", "été"]) for _ in range(30_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards quietly observe from a distant hill"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, SIZE string, shard string, _lm_id string, kept string"


def documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names the operators use."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Été", "ñandú", "x.", "it's", "<b>", "#1"]
    rows = []
    for i in range(60):
        text = " ".join(r.choice(words) for _ in range(r.randint(1, 120)))
        rows.append((i, text, r.choice(["en", "fr"]), r.choice(["a", "b", "c"])))
    rows += [(100, None, "en", "a"), (101, "", "en", None), (102, " \t\n", None, "b"), (None, "no id here", "en", "a"), (None, None, None, None),
             (103, LONG, "en", "a"), (104, LONG + " end", "en", "b"), (5, rows[5][1], "en", "a"), (5, rows[5][1], "en", "a"),
             (6, "another text under the same id", "fr", "c"), (105, PASSAGE, "en", "a"), (106, "before " + PASSAGE + " after", "en", "b"),
             (107, PASSAGE.upper() + "!", "en", "a"), (108, "ï" * 70, "de", "z"), (109, "ï" * 90, "de", "z")]
    rows += [(200 + i, "copy of a copy of a copy of the same text", "en", "a") for i in range(40)]
    return spark.createDataFrame([(*x, None, "s", "z", None, "l", "k") for x in rows], SCHEMA).repartition(7)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark):
    rows = [(1, PASSAGE), (2, "lazy dog while seven wizards quietly observe from a distant hill and then some more words"), (3, "no id"), (4, None), (5, ""),
            (None, "w1 w2"), (7, PASSAGE)]
    return spark.createDataFrame(rows, "item_id long, text string")
