"""Filter audit, conversation trie and mixing against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from assaylake.llm import filter_audit, mixing, turn_trie
from assaylake.llm.radix_tree import Full, Indexed, Sparse, Tree

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# filter audit


def failing(text):
    words = WORD.findall(text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    return out + ("D" if re.search("[#$%&*|]", text) else "")


def brute_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for i, text, source in docs:
        copy = "E" if i is not None and least[text or ""] < i else ""
        parts[source or ""].append((set(failing(text or "") + copy), i in good, i in toxic))
    out, shapley = [], Counter()
    for part, members in parts.items():
        for order in permutations("ABCDE"):
            gone = set()
            for step, f in enumerate(order, 1):
                removed = [m for m in members if f in m[0] and not m[0] & gone]
                redundant = sum(f in m[0] and bool(m[0] & gone) for m in members)
                gone = gone | {f}
                kept = sum(not m[0] & gone for m in members)
                shapley[part, f] += len(removed)
                line = ["".join(order), step, kept, len(removed), redundant, sum(m[0] == {f} for m in members)]
                out.append((part, *line, sum(m[1] for m in removed), sum(m[2] for m in removed), f))
    return Counter((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def audit_docs():
    made = random.Random(5)
    vocabulary = ["alpha", "beta", "Gamma", "delta$", "EPSILON", "zeta", "eta"]
    texts = [" ".join(made.choices(vocabulary, k=made.choice([3, 150, 199, 200, 260]))) for _ in range(12)]
    texts += [" ".join(f"w{made.randrange(10**6)}" for _ in range(220)), "", None, " \t\x0b", "Ünï|", "a b"]
    return [(k if k % 9 else None, made.choice(texts), made.choice(["x", "y", None, ""])) for k in range(140)] + [(7, texts[0], "x"), (7, texts[1], "x"), (7, texts[1], "y")]


@pytest.mark.parametrize("copies,broadcast", [(1024, 500_000), (3, 0)])
def test_audit_is_brute_force(spark, monkeypatch, copies, broadcast):
    monkeypatch.setattr(filter_audit, "COPIES", copies)
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", broadcast)
    docs = audit_docs()
    labels = [(k, k % 2, k % 3 % 2) for k in range(0, 120, 2)] + [(4, 0, 1), (None, 1, 1), (8, None, None), (100000, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "m", 0) for d in docs], "doc_id long, text string, source string, n int, mask string, hash int").repartition(5)
    got = filter_audit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows_of(got) == brute_audit(docs, labels)


def test_audit_of_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, labels).count() == 0
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert rows_of(filter_audit.audit(odd, labels)) == brute_audit(docs, [])


def test_copies_of_different_texts_with_one_hash(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "a", 5), (4, "b", 5), (4, "b", 5)], "doc_id long, text string, hash long")
    assert sorted(r["doc_id"] for r in filter_audit.copies(rows, rows.select("doc_id", "hash")).collect()) == [3, 4, 4]


# radix trees


def test_tree_walks_keys_in_order_whatever_the_layout():
    made = random.Random(3)
    for alphabet, length in ((2, 12), (5, 6), (40, 3), (256, 2)):
        keys = {bytes(made.randrange(alphabet) for _ in range(made.randrange(length + 1))) for _ in range(3000)}
        ordered = list(keys)
        tree = Tree()
        for at, key in enumerate(ordered):
            tree.insert(key, at)
        walked, depth, kinds = [], 0, set()
        for end, value in tree.walk():
            if value >= 0:
                walked.append(ordered[value])
                assert end == len(ordered[value])
            depth += 1 if value != -2 else -1
        assert walked == sorted(keys) and depth == 0
        stack = [tree.root]
        while stack:
            node = stack.pop()
            kids = list(node.children())
            kinds.add(type(node))
            assert len(kids) <= {Sparse: 16, Indexed: 48, Full: 256}[type(node)]
            assert node.value >= 0 or len(kids) > 1 or node is tree.root  # paths are compressed
            stack += kids
        assert (Full in kinds) == (alphabet == 256) and Sparse in kinds


def test_nodes_change_their_layout():
    tree, seen = Tree(), []
    for byte in range(256):
        tree.insert(bytes([byte]), byte)
        seen.append((type(tree.root), getattr(tree.root, "room", None)))
    assert [seen[k - 1] for k in (4, 5, 16)] == [(Sparse, 4), (Sparse, 16), (Sparse, 16)]
    assert [seen[k - 1][0] for k in (17, 48, 49, 256)] == [Indexed, Indexed, Full, Full]


# conversation trie


def brute_trie(turns):
    """turns: (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(rows)] for c, rows in own.items()}
    built = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = (*own.get(c - c % 20, [])[:h], *rows[h:])
    members = defaultdict(list)
    for c, rows in built.items():
        for d in range(len(rows) + 1):
            members[rows[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out, under = [], {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves = sum(under[k][0] for k in kids[node]) if kids[node] else 1
        saved = (len(members[node]) - 1) * words + sum(under[k][1] for k in kids[node])
        under[node] = (leaves, saved)
        ends = ",".join(str(c) for c in sorted(members[node]) if built[c] == node)
        above = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), above, len(members[node]), len(kids[node]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def talk():
    made = random.Random(11)
    says = ["hello there", "yes", "no", "", None, "a b c", "long " * 40]
    turns = []
    for c in [*range(0, 130), 1000, 1003, 1019, 4321]:
        if c % 20 == 0 and c > 90:  # leaders that are absent
            continue
        n = 300 if c == 44 else made.choice([1, 1, 2, 3, 4, 6])
        turns += [(c, k, made.choice(["user", "assistant", None]) if k % 5 == 4 else "user", "yes" if made.random() < 0.5 else made.choice(says)) for k in range(n)]
    turns += [(c, None, "system", "before all others") for c in (3, 60, 77)]
    turns += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    turns += [(c, k, "user", "the same conversation") for c in range(2000, 2000 + 20 * 30, 20) for k in range(3)]
    return turns


@pytest.mark.parametrize("width,broadcast", [(40_000, 200_000), (3, 200_000), (7, 0)])
def test_trie_is_brute_force_in_any_number_of_ranges(spark, monkeypatch, width, broadcast):
    monkeypatch.setattr(turn_trie, "BROADCAST_ROWS", broadcast)
    turns = talk()
    frame = spark.createDataFrame([(*t, b"k", 2, "p") for t in turns], "conv_id long, turn long, role string, text string, key binary, words int, parent string")
    assert rows_of(turn_trie.prefix_trie(frame.repartition(4), width)) == brute_trie(turns)


def test_trie_of_few_turns(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert turn_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    # h of 41 is 2: its leader is absent, and its only turn is left out, so the root alone has it
    assert zlib.crc32(b"41") % 4 > 0
    alone = turn_trie.prefix_trie(spark.createDataFrame([(41, 0, "user", "hi")], schema)).collect()
    assert [tuple(r) for r in alone] == [(41, 0, None, 1, 0, 1, 0, hashlib.sha256(b"41").hexdigest())]
    # repeated turns: both stay, in the order of their ids
    twice = [(20, 1, "user", "b"), (20, 1, "user", "a"), (20, 1, "user", "a")]
    assert turn_trie.prefix_trie(spark.createDataFrame(twice, schema)).count() == 4


def test_trie_of_a_hot_conversation_streams_its_ids(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "BLOCK", 8)
    turns = [(c, 0, "user", "same") for c in range(0, 2000, 20)]
    assert rows_of(turn_trie.prefix_trie(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))) == brute_trie(turns)


# mixing


def brute_targets(source_sizes, weights=(5, 2, 1)):
    names = sorted((s for s in source_sizes if s is not None), key=lambda s: s.encode()) + [s for s in source_sizes if s is None]
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, most, open_, out = 1.5 * sum(source_sizes.values()), {s: 2.0 * n for s, n in source_sizes.items()}, set(names), {}
    while True:
        share = {s: left * w[s] / sum(w[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > most[s]]
        if not above:
            return {**out, **share}
        for s in above:
            out[s] = most[s]
            left -= most[s]
            open_.discard(s)


def check_mix(rows, docs):
    """rows of mix over docs (doc_id, text, source)."""
    want = Counter((i, len(WORD.findall(t or "")), s) for i, t, s in docs)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in rows) == want
    sums = defaultdict(int)
    for _, t, s in docs:
        sums[s] += len(WORD.findall(t or ""))
    targets = brute_targets(sums)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["source_size"] == sums[r["source"]] and math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
    for s, members in by.items():
        least = min((r["size"] for r in members if r["size"]), default=0)
        # within the smallest text, or a fiftieth where a source has a few texts only
        assert abs(sum(r["taken"] for r in members) - targets[s]) <= max(least + 1, targets[s] / 50)
        assert math.isclose(sum(r["rate"] * r["size"] for r in members), targets[s], rel_tol=1e-6, abs_tol=1e-6)
        # the dual's solution: one lambda for all documents below the limit, and none at it that would be below
        inner = [math.log(r["rate"] / 1.5) / r["size"] for r in members if r["size"] and 0 < r["rate"] < 2]
        if inner:
            assert max(inner) - min(inner) <= 1e-6 * max(1e-3, abs(inner[0]))
            assert all(1.5 * math.exp(inner[0] * r["size"]) >= 2 - 1e-6 for r in members if r["rate"] == 2)


def mixed_docs(made, many):
    docs = []
    for s, n in (("b", many), ("a", many // 3), ("Ä", 40), ("", 25), (None, 60), ("zero", 5), ("z\U0001f600", 30)):
        for _ in range(n):
            size = 0 if s == "zero" else made.choice([1, 2, 5, 5, 5, 40, made.randrange(400)])
            docs.append((len(docs), " ".join(["w"] * size) if size or made.random() < 0.5 else None, s))
    return docs


SCHEMA = "doc_id long, text string, source string, size string, n int, rate string, block int"


def frame_of(spark, docs):
    return spark.createDataFrame([(*d, "s", 1, "r", 2) for d in docs], SCHEMA).repartition(6)


@pytest.mark.parametrize("block", [1024, 4])
def test_mix_meets_targets_by_the_tilt(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    docs = mixed_docs(random.Random(2), 900)
    rows = mixing.mix(frame_of(spark, docs)).collect()
    check_mix(rows, docs)
    cells = defaultdict(list)
    for r in rows:
        cells[r["source"], r["size"]].append(r["copies"])
    assert all(max(c) - min(c) <= 1 for c in cells.values())
    again = mixing.mix(frame_of(spark, docs).repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_mix_of_test_data(spark, sample, sf_dir):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in sample]
    check_mix(mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect(), docs)


def test_mix_of_odd_and_empty_tables(spark, odd, empty):
    assert mixing.mix(empty).count() == 0
    check_mix(mixing.mix(odd).collect(), [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()])
    one = [(k, "one two three", "s") for k in range(3)] + [(None, "one two three", None)] * 5
    check_mix(mixing.mix(frame_of(spark, one)).collect(), one)
    nothing = [(1, None, None), (2, "", "a"), (2, " ", "a")]
    check_mix(mixing.mix(frame_of(spark, nothing)).collect(), nothing)


def test_targets_fill_up_by_weight(spark):
    made = random.Random(8)
    for _ in range(3):
        sums = {f"s{k}": made.choice([0, 1, 10, 1000, 100_000]) + made.randrange(9) for k in range(made.randrange(1, 30))} | {None: 50}
        frame = spark.createDataFrame([(s, n) for s, n in sums.items()], "source string, source_size long").repartition(5)
        got = {r["source"]: r["target"] for r in mixing.with_targets(frame).collect()}
        want = brute_targets(sums)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)
