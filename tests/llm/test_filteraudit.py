import re
from itertools import permutations

from tabspark.llm import filteraudit
from tests.llm.fixtures import SCHEMA, empty, rows

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """Every order applied document by document."""
    labelled = {k: {i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1)}
    judged = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)}
        judged.append((i, lang or "", fails))
    out = {}
    for part in {p for _, p, _ in judged}:
        own = [(i, f) for i, p, f in judged if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if d[1][letter]]
                left = [d for d in left if not d[1][letter]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[letter] for _, f in own) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    *[sum(i in labelled[k] for i, _ in gone) for k in (0, 1)]]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def frames(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, "c", 7, "n", 9, "h") for i, t, lang in docs], SCHEMA)
    return (d.withColumnsRenamed({"chunk": "mask", "part": "part", "node": "digest", "h": "n"}).repartition(5),
            spark.createDataFrame([(*r, "x", 3) for r in labels], "doc_id long, quality int, toxic int, part string, n int"))


def got(frame):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in frame.collect()}


def test_against_brute_force(spark):
    langs = ["en", "de", None, ""]
    docs = [(i, t, langs[k % 4]) for k, (i, t) in enumerate(rows())]
    docs += [(700 + i, "a third of all rows $ " * (i % 2), "en") for i in range(60)]
    docs += [(800, "ABC DEF # 1", "en"), (801, "ABC DEF # 1", "de"), (800, "ABC DEF # 1", "de"), (None, "ABC DEF # 1", "en"),
             (802, " ".join(f"Äé{k}" for k in range(100)), "fr"), (803, " ".join(["AB cdefgh"] * 9 + [f"q{k}é" for k in range(95)]), "fr"),
             (804, "x\u0085y z\x1cw", "fr")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 900, 2)] + [(1, None, None), (None, 1, 1), (5, 0, 0), (5, 1, 0), (5, 1, 1)]
    assert got(filteraudit.filter_audit(*frames(spark, docs, labels))) == brute(docs, labels)


def test_intervals_cover_each_order_once():
    orders = ["".join(p) for p in permutations("ABCDE")]
    for mask in range(32):
        seen = {}
        for step, a, b in filteraudit.removal_intervals(mask):
            for r in range(a, b):
                assert r not in seen
                seen[r] = step
        fails = {f for k, f in enumerate("ABCDE") if mask >> k & 1}
        assert seen == ({r: min(o.index(f) for f in fails) for r, o in enumerate(orders)} if fails else {})


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.filter_audit(empty(spark), none).count() == 0
    docs, _ = frames(spark, [(1, None, None)], [])
    assert got(filteraudit.filter_audit(docs, none)) == brute([(1, None, None)], [])
