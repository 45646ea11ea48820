"""Small documents with every case the operators define: nulls, empty and long texts, copies, repeated rows."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, chunk string, part long, node string, key long, h string"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}{rng.choice(['', ',', '.'])}" for _ in range(n))


def rows(seed=1):
    """(doc_id, text) with nulls, repeated rows, near copies and shared passages."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    out = []
    for i in range(40):
        text = prose(rng, rng.randrange(1, 160), 4000)
        if i % 5 == 0:
            text += "\n" + passage + "\t" + prose(rng, 7, 4000)
        out.append((i, text))
    base = prose(rng, 120, 4000)
    for i in range(100, 112):  # near copies of one text, one word changed in each
        own = base.split()
        own[rng.randrange(len(own))] = f"changed{i}"
        out.append((i, " ".join(own)))
    out += [(200 + i, base) for i in range(6)]  # exact copies
    out += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "a b c d"), (305, "a  b c\nd")]
    out += [(306, " ".join(["again and again it says"] * 30)), (307, prose(rng, 6000, 900)), (308, "x" * 5000)]
    out += [(309, "Été déjà vu — naïve 東京 😀 <|endoftext|> <|startoftext|> it's İ ΑΣ x y\u0085z"), (309, out[3][1])]
    out += [out[0], out[0], (None, out[1][1]), (None, "only here, without an id"), (None, "only here, without an id")]
    return out


def documents(spark, own=None):
    """The rows with other columns, some named like columns inside the operators."""
    data = [(i, t, "en", "c", 7, "n", 9, "h") for i, t in (rows() if own is None else own)]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
