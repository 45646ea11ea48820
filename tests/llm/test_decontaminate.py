import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tabspark.llm import decontaminate
from tests.llm.fixtures import documents, empty, rows, words


def brute(docs, items, similarity=0.8):
    """Every window of every document against every item."""
    out = []
    for doc_id, text in docs:
        own = words(text)
        for item_id, item in items:
            want = words(item)
            n, k = len(want), min(5, len(want))
            if not n or len(own) < n:
                continue
            y = Counter(tuple(want[i:i + k]) for i in range(n - k + 1))
            best = None
            for s in range(len(own) - n + 1):
                x = Counter(tuple(own[i:i + k]) for i in range(s, s + n - k + 1))
                c = sum((x & y).values())
                j = c / (2 * (n - k + 1) - c)
                if j >= similarity and (best is None or j > best[1] + 1e-12):
                    best = (s, j)
            if best:
                out.append((doc_id, item_id, best[0], n, round(best[1], 9)))
    return sorted(out, key=repr)


def planted():
    data = rows()
    passage = words(data[5][1])[2:40]
    items = [(1, " ".join(passage)), (2, " ".join(passage[:-1] + ["other"])), (3, "a  b c\td"), (4, None), (5, ""),
             (6, "says again and again it says again and again it"), (7, "one"), (8, " ".join(passage)), (9, "never seen before in it")]
    data += [(400, "x y " + " ".join(passage) + " z"), (401, " ".join(passage[:20] + ["in"] + passage[20:]))]
    return data, items


def table_of(spark, items):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, length int, m int")


def test_matches_brute_force(spark):
    data, items = planted()
    got = decontaminate.contaminated(documents(spark, data), table_of(spark, items)).collect()
    assert sorted([(r["doc_id"], r["item_id"], r["start"], r["n_words"], round(r["similarity"], 9)) for r in got],
                  key=repr) == brute(data, items)


@pytest.mark.parametrize("bound", [0])
def test_without_broadcasts(spark, monkeypatch, bound):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
    data, items = planted()
    docs = documents(spark, data)
    left = decontaminate.without_contaminated(docs, table_of(spark, items))
    assert left.columns == docs.columns
    bad = {r[0] for r in brute(data, items)}
    assert sorted([r["doc_id"] for r in left.collect()], key=repr) == sorted([i for i, _ in data if i not in bad], key=repr)


def test_empty_tables(spark):
    _, items = planted()
    assert decontaminate.contaminated(empty(spark), table_of(spark, items)).count() == 0
    assert decontaminate.contaminated(documents(spark), table_of(spark, items).limit(0)).count() == 0
    assert decontaminate.without_contaminated(documents(spark), table_of(spark, items).limit(0)).count() == len(rows())


def test_blocks_find_all_within_the_radius(spark):
    """Pigeonhole: radius + 1 blocks, so some block is untouched by up to radius flipped bits."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        pairs.append((a - (1 << 63), b - (1 << 63)))
    df = spark.createDataFrame(pairs, "a long, b long")
    met = df.where(F.size(F.array_intersect(*[decontaminate.blocks(F.col(c), decontaminate.RADIUS) for c in "ab"])) > 0)
    assert met.count() == len(pairs)


def test_rows_of_one_id_are_judged_each_for_itself(spark, monkeypatch):
    items = planted()[1][:1]
    passage = items[0][1]
    data = [(None, f"x {passage} y"), (None, "clean, without an id"), (None, None), (7, f"z {passage}"), (7, "clean, with the id 7"),
            (7, "clean, with the id 7"), (8, "clean")]
    for bound in (decontaminate.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", bound)
        left = decontaminate.without_contaminated(documents(spark, data), table_of(spark, items)).collect()
        assert sorted([(r["doc_id"], r["text"]) for r in left], key=repr) == sorted(
            [r for r in data if passage not in (r[1] or "")], key=repr)


def brute_with_short(docs, items, similarity=0.8):
    """``brute``, and a document shorter than the item as its one window."""
    out = brute(docs, items, similarity)
    for doc_id, text in docs:
        own = words(text)
        for item_id, item in items:
            want = words(item)
            n, k = len(want), min(5, len(want))
            if not k <= len(own) < n:
                continue
            x, y = (Counter(tuple(v[i:i + k]) for i in range(len(v) - k + 1)) for v in (own, want))
            c = sum((x & y).values())
            j = c / (len(own) + n - 2 * (k - 1) - c)
            if j >= similarity:
                out.append((doc_id, item_id, 0, len(own), round(j, 9)))
    return sorted(out, key=repr)


def test_documents_shorter_than_the_item(spark):
    item = [f"w{i % 50}" for i in range(59)]
    small = [f"v{i}" for i in range(9)]  # 5 shingles
    items = [(1, " ".join(item)), (2, " ".join(small))]
    cuts = [item[1:], item[:-1], item[5:-4], item[7:], item[11:], item[12:], item[:30], item[:3], item[:20] + item[21:],
            item[:20] + ["in"] + item[22:], small[1:], small[:-1], small[2:], small[:4], ["a"] + item + ["b"]]
    data = [(i, " ".join(c)) for i, c in enumerate(cuts)]
    want = brute_with_short(data, items)
    assert {0, 1, 2, 3, 4, 8, 10, 11} <= {r[0] for r in want} and not {5, 6, 7, 12, 13} & {r[0] for r in want}
    got = decontaminate.contaminated(documents(spark, data), table_of(spark, items)).collect()
    assert sorted([(r["doc_id"], r["item_id"], r["start"], r["n_words"], round(r["similarity"], 9)) for r in got], key=repr) == want


def test_fingerprints_of_very_long_texts(spark):
    """More shingles than a 16-bit counter holds."""
    rng = random.Random(9)
    kinds = [rng.getrandbits(64) - (1 << 63) for _ in range(7)]
    own = [kinds[i % 7 if i % 3 else 0] for i in range(140_001)]
    want = 0
    for bit in range(64):
        ones = sum((h >> bit) & 1 for h in own)
        want |= (2 * ones > len(own)) << bit
    got = spark.createDataFrame([(own,)], "s array<long>").select(decontaminate.simhash(F.col("s")).alias("f")).first()["f"]
    assert got % (1 << 64) == want
