"""Spelling variants, SentencePiece coding and periodic runs against brute force or the library."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from zlib import crc32

import public_tokenizers
import pytest
import sentencepiece

from conftest import values
from rivulet.llm import queries_repetitions, queries_sentencepieces, queries_spelling, repetitions, sentencepieces, spelling
from tests.llm.data import documents, lower, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def run_query(monkeypatch, module, name, docs):
    monkeypatch.setattr(module, "table", lambda spark, sf_dir, table: docs)
    return getattr(module, name)(docs.sparkSession, "")


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, word string, runs int")


# -- SentencePiece


def test_codec_is_the_library():
    codec = sentencepieces.Codec(open(MODEL, "rb").read(), kept=50)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(4)
    letters = "aeiotn rs▁éß日🎉\n\x00<s>0x1　"
    samples = ["", " ", "   ", "▁", " a", "a ", "aaaaaaaaa", "<s></s><0x0A>", "x" * 3000, " " * 70, "\n" * 9, *texts()]
    samples += ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    samples += ["".join(rng.choice(codec.pieces[3:]) for _ in range(9)).replace("▁", " ") for _ in range(500)]
    for text in samples:
        ids = codec.encode(text)
        assert ids == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids), text
    for _ in range(1500):  # ids that no text gives: bytes that are no characters
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randrange(1, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_pieces_of_documents(spark, monkeypatch):
    docs = documents(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for id_, text in rows_of(docs):
        ids = library.encode(text)
        want.append((id_, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = run_query(monkeypatch, queries_sentencepieces, "op12_sentencepiece", docs)
    assert values(got) == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    assert sentencepieces.coded(empty(spark), MODEL).count() == 0


# -- Periodic runs


def slow_runs(words, least=6, times=4):
    found = set()
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, times * p) and not any(words[i : j + p - q] == words[i + q : j + p] for q in range(1, p)):
                found.add((i, length, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("run", [repetitions.Run(), repetitions.Run(2, 2), repetitions.Run(4, 3), repetitions.Run(6, 2)])
def test_runs_of_small_alphabets(run):
    rng = random.Random(run.least)
    for turn in range(400):
        words = [str(rng.randrange(rng.choice([1, 2, 3, 6]))) for _ in range(rng.randrange(40))]
        if turn % 2:
            root = [str(rng.randrange(3)) for _ in range(rng.randrange(1, 9))]
            words = words + root * rng.randrange(9) + root[: rng.randrange(len(root) + 1)] + words[:5]
        assert [tuple(r) for r in repetitions.runs_of(words, run).tolist()] == slow_runs(words, run.least, run.times), words
        symbols = [int(w) for w in words]
        assert [tuple(r) for r in repetitions.maximal_runs(symbols, run).tolist()] == slow_runs(words, run.least, run.times), words


def planted(id_, words):
    h = crc32(str(id_).encode()) if id_ is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_of_documents(spark, monkeypatch):
    rows = [(i, t, "s") for i, t in enumerate(texts(9, 160))]
    rows += [(1000 + i, " ".join(["la"] * i), "s") for i in range(12)] + [(1100, "a b a b a b a b\na b c " * 30, "s")]
    rows += [(None, "a a a a a a a", "s"), (None, None, None), (5, "", "s"), (6, " \n", "s"), (7, None, "s"), rows[3], rows[3]]
    docs = documents(spark, rows)
    want = []
    for id_, text in rows_of(docs):
        words = planted(id_, re.findall(r"[^\x20\x09-\x0D]+", text))
        runs = slow_runs(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        drop = {k for s, n, p in runs for k in range(s + p, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        milli = 1000 * best[1] // best[2] if runs else None
        want.append((id_, len(runs), *best, milli, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept)))
    assert any(crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in want)
    got = run_query(monkeypatch, queries_repetitions, "op13_repetitions", docs)
    assert values(got) == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    assert repetitions.detected(empty(spark)).count() == 0


def test_long_runs():
    assert repetitions.runs_of(["w"] * 30_000).tolist() == [[0, 30_000, 1]]
    words = [str(i % 700) for i in range(30_000)]
    assert repetitions.runs_of(["x", *words, "y"]).tolist() == [[1, 30_000, 700]]


# -- Spelling variants


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_groups(counts, s):
    words = {w: n for w, n in counts.items() if len(w) >= s.letters and n >= s.count}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    forms = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= s.times * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, words[w], len(near[w]), words.get(forms[w])))
    return out


@pytest.mark.parametrize("block", [8192, 3])
def test_neighbours_of_a_dense_vocabulary(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(3, 8))): rng.choice([2, 2, 3, 30, 30, 400, 9000]) for _ in range(300)}
    s = spelling.Spelling(letters=3, block=block)
    got = {(r.word, r.n_near, r.near, r.near_n) for r in spelling.neighbours(spark.createDataFrame(list(words.items()), "word string, n long"), s).collect()}
    want = set()
    for w in words:
        near = [v for v in words if one_apart(w, v)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want.add((w, len(near), best, words[best]))
    assert got == want


def test_spelling_of_documents(spark, monkeypatch):
    rng = random.Random(2)
    base = ["natural", "naturel", "Naturally", "àéîõüßñ", "abcdefgh", "abcdefghi", "bcdefgh", "short", "aaaaaaa", "aaaaaaaa"]
    weights = [600, 30, 60, 40, 300, 20, 3, 50, 200, 20]
    rows = [(i, " ".join(rng.choices(base, weights, k=60)) + ", x÷naturals×natural's", "s") for i in range(60)]
    rows += [(None, "natural " * 5, "s"), (None, None, None), (5, "", "s"), rows[3], rows[3], (900, "z" * 50_000 + " ", "s"), (901, "z" * 50_000, "s")]
    docs = documents(spark, rows)
    counts = Counter()
    for id_, text in rows_of(docs):
        for word in re.findall("[A-Za-zÀ-ÿ]+", text):
            word = lower(word)
            h = crc32(f"{id_}:{word}".encode())
            if id_ is not None and h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    want = slow_groups(counts, spelling.Spelling())
    assert any(r[1] for r in want)
    got = run_query(monkeypatch, queries_spelling, "op11_spelling", docs)
    assert values(got, "word", "form", "root", "n", "n_near", "form_n") == sorted(want, key=lambda r: [(v is not None, v) for v in r])
    assert spelling.grouped(empty(spark)).count() == 0


def test_roots_follow_chains(spark):
    counts = {"abcdefg": 2, "abcdefh": 20, "abcdeih": 200, "abcjeih": 2000, "abkjeih": 20000, "ablmnop": 9}
    rows = [(w, n) for w, n in counts.items()]
    near = spark.createDataFrame(rows, "word string, n long")
    docs = near.selectExpr("1L AS doc_id", "repeat(concat(word, ' '), int(n)) AS text")
    got = {(r.word, r.form, r.root) for r in spelling.grouped(docs).collect()}
    assert got == {(w, f, r) for w, f, r, *_ in slow_groups(counts, spelling.Spelling())}
    assert ("abcdefg", "abcdefh", "abkjeih") in got
