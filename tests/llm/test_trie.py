import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np

from tabspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth long, id string, part int, key string, bytes long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", 2, "k", 3) for r in rows], SCHEMA).repartition(3)


def nodes_of(sequences):
    """{conv_id: [turn, ...]} to the rows of all nodes; a turn is (role, text)."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, out = defaultdict(list), []
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
    for p, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(sequences[c]) == len(p))))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    """The conversations as the contract words them; equal turns by role, then by the digest of the text."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def same(got, want):
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(160):
        if c % 11 == 5:
            continue  # absent, some of them the first of a family
        for turn in range(rng.choice([1, 2, 3, 6, 9, 14])):
            text = rng.choice(["yes", "no, it is not", "naïve é 東京", ""]) if rng.random() < 0.8 else f"t{rng.random()}"
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn % 3 else "user", text))
    rows += [(c, turn, "user", "the same") for c in range(1000, 1100) for turn in range(9)]  # copies
    rows += [(2000, turn, "user", f"long {turn}") for turn in range(700)]
    rows += [(2001, turn, "user", f"long {turn}") for turn in range(650)]
    rows += [(3, None, "user", "first"), (3, None, None, "first"), (4, None, "user", None), (4, 2, None, "x"), (4, 2, None, "y")]
    rows += [(None, 0, "user", "nobody's"), (7, 1, "user", "again"), (7, 1, "user", "again"), (-3, 0, "user", "below zero")]
    return rows


def test_conversations(spark):
    rows = conversations(1)
    same(trie.conversation_trie(table(spark, rows)), nodes_of(rebuilt(rows)))


def sequences(spark, texts):
    """Sequences {conv_id: [text, ...]} as the operator takes them."""
    def digest(t):
        return hashlib.sha256(t.encode()).digest()[:trie.DIGEST]
    rows = [(c, bytearray(b"".join(map(digest, own))), [len(t.encode()) for t in own]) for c, own in texts.items()]
    return spark.createDataFrame(rows, "conv_id long, key binary, sizes array<long>")


def test_nodes_over_many_partitions(spark):
    rng = random.Random(3)
    for k, lengths in enumerate([(0, 3), (1, 12), (6, 7)]):
        texts = {c: [rng.choice("ab") * 3 for _ in range(rng.randrange(lengths[0], lengths[1] + 1))]
                 for c in rng.sample(range(10_000), 400)}
        texts |= {20_000 + c: ["a"] * 40 for c in range(300)}  # one path over several partitions
        got = trie.prefix_trie(sequences(spark, texts), part_bytes=200 if k else 1 << 20)
        same(got, nodes_of({c: [("", t) for t in own] for c, own in texts.items()}))


def test_pieces_of_the_ids(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_PER_PIECE", 7)
    keys, left = [b"x" * 16] * 30, 1
    rows = trie.forest_rows(keys, np.arange(30), [np.array([4])] * 30, left, 1, 0).to_pylist()
    pieces = [r["ids"] for r in rows if r["state"] == "ends"]
    assert len(pieces) == 5 and ",".join(pieces) == ",".join(map(str, range(30)))
    data = [(bytearray(b"n"), part, k, text) for part, k, text in [(1, 0, "3,4"), (0, 1, "2"), (0, 0, "0,1")]]
    frame = spark.createDataFrame([*data, (bytearray(b"m"), 5, 0, "9")], "id binary, part int, piece int, ids string")
    got = {bytes(r["id"]): r["ends_sha256"] for r in trie.joined_ends(frame).collect()}
    assert got == {b"n": hashlib.sha256(b"0,1,2,3,4").hexdigest(), b"m": hashlib.sha256(b"9").hexdigest()}


def test_empty_and_single(spark):
    assert trie.conversation_trie(table(spark, [])).count() == 0
    assert trie.conversation_trie(table(spark, [(None, 1, "user", "x")])).count() == 0
    one = [(6, 0, "user", "hello")]  # its family's first is absent, so its head is gone
    same(trie.conversation_trie(table(spark, one)), nodes_of(rebuilt(one)))
