"""Windows, suffix tree and Jaccard join over blocks, against brute force."""

import collections
import hashlib
import math
import random
import time
import tracemalloc
import zlib

import pytest
from pyspark.sql import functions as F

from rivulet.llm import blocks, jaccard, suffix_tree, windows
from rivulet.llm.common import stored

from .data import documents, words

LAST = 1 << 63


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def brute_windows(rows, size=50):
    first = {}
    for i, t in rows:
        data, i = (t or "").encode(), LAST if i is None else i
        for p in range(len(data) - size + 1):
            w = data[p : p + size]
            first[w] = min(first.get(w, LAST), i)
    out = []
    for i, t in rows:
        data, mine = (t or "").encode(), LAST if i is None else i
        gone = bytearray(len(data))
        for p in range(len(data) - size + 1):
            if first[data[p : p + size]] < mine:
                gone[p : p + size] = b"\1" * size
        runs = sum(1 for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("block_bytes", [700, 1 << 20])
def test_windows(spark, block_bytes):
    docs = documents(spark).cache()
    got = windows.deduplicated(docs, windows.Depth(block_bytes=block_bytes)).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_windows(plain(docs))


def test_windows_of_one_long_repeat(spark):
    rows = [(i, "ab" * 100 + "tail" * i, "s") for i in range(6)] + [(9, "é" * 24 + "x", "s"), (10, "é" * 24 + "xy" + "é" * 24 + "x", "s")]
    docs = documents(spark, rows)
    got = windows.deduplicated(docs, windows.Depth(block_bytes=300)).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_windows([r[:2] for r in rows])


def test_windows_of_bit_parities_are_told_apart(spark):
    """Hashes of a polynomial modulo 2^64 cannot tell these two windows apart."""
    size = 2048
    one = "".join("ab"[i.bit_count() % 2] for i in range(size))
    rows = [(1, one, "s"), (2, one.translate(str.maketrans("ab", "ba")), "s"), (3, "x" + one, "s")]
    got = windows.deduplicated(documents(spark, rows), windows.Depth(window=size, block_bytes=3 * size)).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_windows([r[:2] for r in rows], size)


@pytest.mark.parametrize("window, digit", [(50, 24), (9, 5), (12, 12), (30, 8)])
def test_windows_of_pieces(spark, monkeypatch, window, digit):
    """Texts that are longer and shorter than the pieces in which digits are hashed."""
    monkeypatch.setattr(windows, "_PIECE", 64)
    docs = [(i, t) for i, t in plain(documents(spark)) if len(t or "") < 9000]
    lens, data = [len((t or "").encode()) for _, t in docs], "".join(t or "" for _, t in docs).encode()
    block = blocks.Block(0, [i for i, _ in docs], lens, blocks.squeezed(data))
    s = windows.Suffixes(block, windows.Depth(window, digit))
    at, ids = s.windows(range(len(s.low)))
    want = [(a + k, n) for a, n in zip(block.starts.tolist(), lens) for k in range(n - window + 1)]
    assert at.tolist() == [p for p, _ in want] and (s.head >= s.low).all() and (s.high - s.head <= window - digit).all()
    assert ids.tolist() == [block.ids[k] for k, n in enumerate(lens) for _ in range(max(0, n - window + 1))]
    head = dict(zip(at.tolist(), [h for h, a, b in zip(s.head.tolist(), s.low, s.high) for _ in range(b - a + 1)]))
    steps = collections.defaultdict(set)
    for p, h in head.items():
        steps[data[p : p + window]].add(h - p)
    assert all(len(x) == 1 for x in steps.values())


def test_windows_need_little_more_than_the_text():
    """Digits and heads of a block are found without arrays of numbers as long as its text; those cost most of the CPU seconds."""
    data = random.Random(1).randbytes(1 << 21)
    block = blocks.Block(0, [1, 2], [1 << 20, 1 << 20], blocks.squeezed(data))
    tracemalloc.start()
    try:
        windows.Suffixes(block, windows.Depth())
        assert tracemalloc.get_traced_memory()[1] < 16 * len(data)
    finally:
        tracemalloc.stop()


def brute_base(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = collections.Counter()
    for i, t in rows:
        if not held(i):
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(base, 6)))
    return collections.Counter(out)


@pytest.mark.parametrize("block_bytes", [900, 1 << 20])
def test_suffix_tree_base(spark, block_bytes):
    docs = documents(spark).cache()
    got = suffix_tree.scored(docs, suffix_tree.Tree(block_bytes=block_bytes)).collect()
    assert collections.Counter((*r[:5], round(r.base_score, 6)) for r in got) == brute_base(plain(docs))


def brute_tree(rows, tree):
    """The whole model with dictionaries."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % tree.folds == tree.fold
    train = [("^", *words(t), "$") for i, t in rows if not held(i)]
    depth = len(tree.least)
    count = collections.Counter(s[a : a + k] for s in train for k in range(1, depth + 2) for a in range(len(s) - k + 1))
    c1 = collections.Counter(w for s in train for w in s[1:])
    n, v, m = sum(c1.values()), len(c1), tree.weight
    root = lambda x: (c1[x] + 0.5) / (n + 0.5 * (v + 1))

    def contexts(s, j):
        """Frequent contexts of the token, shortest first; each needs its own beginnings to be frequent."""
        fine = lambda c: all(count[c[:k]] >= max(2, tree.least[k - 1]) for k in range(1, len(c) + 1))
        return [s[j - k : j] for k in range(1, min(j, depth) + 1) if fine(s[j - k : j])]

    def chain(s, j, less):
        p, out = root(s[j]), []
        for c in contexts(s, j):
            longer = (count[(*c, s[j])] - less + m * p) / (count[c] - less + m)
            out.append((c, longer, p))
            p = longer
        return out

    gain = collections.Counter()
    for s in train:
        for j in range(1, len(s)):
            for c, longer, parent in chain(s, j, 1):
                gain[c] += math.log(longer / parent)
    out = []
    for i, t in rows:
        s, total = ("^", *words(t), "$"), 0.0
        for j in range(1, len(s)):
            p = root(s[j])
            for c, longer, _ in chain(s, j, 0):
                p = longer if gain[c] > tree.gain else p
            total += math.log10(p)
        out.append((i, round(total, 4)))
    return collections.Counter(out)


def test_suffix_tree_names_contexts_by_short_numbers(spark, monkeypatch):
    """The counts have told which contexts there are; gains need not name them by 40 bits again, nor keys spoil what small numbers compress to."""
    sizes = {}

    def sized(questions, kinds, answer, number, *more, **named):
        sizes[number] = questions.agg(F.sum(F.length("payload"))).first()[0]
        return blocks.answered(questions, kinds, answer, number, *more, **named)

    monkeypatch.setattr(suffix_tree, "answered", sized)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(60 * rng.random() ** 2)}" for _ in range(100)), "s") for i in range(400)]
    rows += [(i * 5, None, None) for i in range(3)]
    tree = suffix_tree.Tree()
    got = suffix_tree.scored(documents(spark, rows).coalesce(1), tree).collect()
    assert collections.Counter((r.doc_id, round(r.score, 4)) for r in got) == brute_tree([r[:2] for r in rows], tree)
    train = [("^", *words(t), "$") for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    count = [collections.Counter(s[a : a + k] for s in train for a in range(len(s) - k)) for k in (1, 2)]
    contexts = sum(n >= least for c, least in zip(count, tree.least) for n in c.values())
    assert contexts > 1500 and sizes[4] < 4.5 * contexts


@pytest.mark.parametrize("least, gain", [((3, 2), 0.5), ((2, 2, 2), 0.3), ((9,), 0.5), ((4, 3, 2, 2), 3.0)])
def test_suffix_tree_scores(spark, least, gain):
    docs = documents(spark).cache()
    tree = suffix_tree.Tree(least=least, gain=gain, block_bytes=900)
    got = collections.Counter((r.doc_id, round(r.score, 4)) for r in suffix_tree.scored(docs, tree).collect())
    assert got == brute_tree(plain(docs), tree)


def brute_jaccard(rows, k, percent):
    """Row by row, as an id may repeat with another text."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    group = [LAST if i is None else i for i, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    return collections.Counter((i, len(s), None if g == LAST else g) for (i, _), s, g in zip(rows, sets, group))


@pytest.mark.parametrize("k, percent, combined, small, block_bytes", [(3, 90, 400, 8, 1 << 20), (1, 70, 30, 6, 900)])
def test_jaccard(spark, k, percent, combined, small, block_bytes):
    docs = documents(spark).where("doc_id IS NOT NULL OR text IS NULL").cache()
    how = jaccard.Join(words=k, percent=percent, combined=combined, small=(small, 2 * small), block_bytes=block_bytes, cells=4096, frequent=2)
    got = collections.Counter(tuple(r) for r in jaccard.joined(docs, how).collect())
    assert got == brute_jaccard(plain(docs), k, percent)


def test_jaccard_of_a_large_group_without_all_pairs(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: i % 50], f"new{i}", *base[i % 50 + 1 :]]), "s") for i in range(40)]
    docs = documents(spark, rows)
    got = collections.Counter(tuple(r) for r in jaccard.joined(docs, jaccard.Join(words=1, percent=96, small=(4, 8), cells=4096, frequent=2)).collect())
    assert got == brute_jaccard([r[:2] for r in rows], 1, 96)


def test_jaccard_follows_each_link_in_one_round(spark, monkeypatch):
    """Later rounds go through new links between components only, and a round without links through none."""
    base, calls = [f"w{i}" for i in range(60)], []
    rows = [(i * 7 % 20, " ".join([*(f"new{j}" for j in range(i)), *base[i:]]), "s") for i in range(20)]  # a chain
    rows += [(100 + i, " ".join([*base[:30], *(f"x{i}y{j}" for j in range(30))]), "s") for i in range(20)]  # share words and link with none
    find = jaccard.components

    def watched(links):
        calls.append({frozenset(r) for r in links.select("a", "b").collect()})
        return find(links)

    monkeypatch.setattr(jaccard, "components", watched)
    got = collections.Counter(tuple(r) for r in jaccard.joined(documents(spark, rows), jaccard.Join(words=1, percent=96, small=(4, 8), cells=4096, frequent=2)).collect())
    assert got == brute_jaccard([r[:2] for r in rows], 1, 96)
    assert calls and all(calls) and sum(map(len, calls)) == len(set().union(*calls))


@pytest.mark.parametrize("groups", [[[5, 3, 9, 1, 7, 2, 8]], [[4, 2], [9, 6, 7, 11, 10, 8], [30, 20]], [list(range(40, 0, -1)), [50, 60, 45]]])
def test_components_of_chains(spark, groups):
    links = spark.createDataFrame([pair for g in groups for pair in zip(g, g[1:])], "a bigint, b bigint")
    assert {tuple(r) for r in jaccard.components(links).collect()} == {(i, min(g)) for g in groups for i in g}


@pytest.mark.parametrize("run", [windows.deduplicated, suffix_tree.scored, jaccard.joined])
def test_empty(spark, run):
    assert run(documents(spark, [])).collect() == []


def test_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    got = suffix_tree.scored(documents(spark, [(i, "a b", "s") for i in held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0)] * 3 and all(r.base_score == r.score == 0 for r in got)


def test_jaccard_keys_are_the_rarest_shingles(spark):
    rows = []
    for i in range(60):  # a third of each text is a passage that others have too, too few for it to be frequent
        passage = " ".join(f"p{i % 4}w{j}" for j in range(20))
        rows.append((i, " ".join(f"d{i}w{j}" for j in range(40)) + " " + passage, "s"))
    rows.append((60, rows[0][1].replace("d0w39", "other"), "s"))
    docs, join = documents(spark, rows), jaccard.Join()
    found = jaccard.features(blocks.packed(docs, join.block_bytes), join)
    assert {r.doc_id for r in found.where(F.size("keys") > 0).collect()} == {0, 60}
    assert {r.doc_id: r.component_id for r in jaccard.joined(docs, join).collect()} == {**{i: i for i in range(60)}, 60: 60 if jaccard_of(rows[0][1], rows[60][1]) < 0.9 else 0}


def jaccard_of(a, b):
    a, b = ({tuple(w[j : j + 3]) for j in range(len(w) - 2)} for w in (words(a), words(b)))
    return len(a & b) / len(a | b)


def test_stored_leaves_no_shuffle_files(spark):
    files = lambda: {x for x in spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(name)
    rows = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).applyInArrow(lambda t: t.select(["id"]), "id bigint"), "rows")
    for _ in range(100):  # they go in the background
        if left := files() - before:
            time.sleep(0.1)
    assert not left and spark.conf.get(name) == was
    assert sorted(r.id for r in rows.collect()) == list(range(1000))
