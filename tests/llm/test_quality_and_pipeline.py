"""Quality classifier, decontamination and the stages of the pipeline, against planted cases and brute force."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivulet.llm import decontamination, quality, secrets

from .data import CLASHING, documents, words

HOW = quality.Training(rows=60, epochs=6)


def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "turns", "slowly", "under", "bridges", "while", "people", "walk", "home"]) for _ in range(n)) + "."


def junk(rng, n):
    return " ".join("".join(rng.choice("$#@!%7391zxq") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def labelled(seed=8, n=240):
    rng = random.Random(seed)
    return [(i, (prose if i % 2 else junk)(rng, rng.choice([12, 40, 300])), i % 2) for i in range(n)]


def labels(spark, rows):
    return spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")


def test_quality(spark):
    rows = labelled()
    odd = [(None, rows[1][1]), (9001, None), (9002, ""), (9003, rows[1][1]), (3, rows[3][1]), (9004, prose(random.Random(1), 30000)), (9005, "x")]
    docs = documents(spark, [(i, t, "s") for i, t in [*((i, t) for i, t, _ in rows), *odd]])
    marks = labels(spark, rows).union(spark.createDataFrame([(None, 1), (5, None), (7, 0), (7, 1)], "doc_id bigint, quality int"))
    got = quality.classified(docs, marks, how=HOW).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter([*(i for i, *_ in rows), *(i for i, _ in odd)])
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    score = {r.doc_id: r.score for r in got}
    assert score[None] == pytest.approx(score[1]) and score[9003] == pytest.approx(score[1]) and score[9004] > 0.5
    assert score[9001] == score[9002]
    again = quality.classified(docs.repartition(5), marks, how=HOW).collect()
    assert sorted((str(r.doc_id), round(r.score, 4)) for r in again) == sorted((str(r.doc_id), round(r.score, 4)) for r in got)


def test_quality_of_nothing(spark):
    docs = documents(spark, [(1, "a", "s"), (None, None, "s")])
    assert quality.classified(documents(spark, []), labels(spark, labelled(n=6)), how=HOW).collect() == []
    assert {r.score for r in quality.classified(docs, labels(spark, labelled()).limit(0), how=HOW).collect()} == {0.5}
    assert quality.accepted(docs, None).columns == docs.columns


def edits(a, b):
    """Least edits between ``a`` and any stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_decontamination(spark):
    rng = random.Random(2)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    items = [(i, letters(14)) for i in range(12)]
    rows = []
    for i in range(60):
        item, kind = items[i % 12][1], i % 4
        if kind == 1:
            at = rng.randrange(len(item))
            item = item[:at] + "Z" + item[at + 1 :]
        inside = {0: item, 1: item, 2: item.upper().replace(" ", "\n  "), 3: ""}[kind]
        rows.append((i, f"{letters(rng.choice([0, 5, 400]))} {inside} {letters(6)}", "s"))
    rows += [(100, None, "s"), (101, "", "s"), (None, items[0][1], "s"), (None, letters(9), "s"), rows[0], rows[3]]
    docs = documents(spark, rows)
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (None, letters(12)), items[3]], "item_id bigint, text string")
    bench = bench.select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHING)))
    flat = lambda t: re.sub(r"\s+", " ", t or "").lower()
    share = decontamination.Budget().share
    dirty = [any(edits(flat(t), flat(x)) <= len(t) * share for _, t in items) for _, x, _ in rows]
    kept = collections.Counter((r.doc_id, r.text) for r in decontamination.clean(docs, bench).collect())
    assert kept == collections.Counter((i, x) for (i, x, _), d in zip(rows, dirty) if not d)
    places = decontamination.contamination(docs, bench).collect()
    assert {r.doc_id for r in places} == {i for (i, _, _), d in zip(rows, dirty) if d}
    assert decontamination.clean(docs, bench.limit(0)).count() == len(rows)
    assert decontamination.clean(documents(spark, []), bench).collect() == []


def test_decontamination_sends_only_texts_to_python(spark):
    item = "a passage of the benchmark that nobody should learn from"
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "nothing of it"), (3, None)], "doc_id bigint, text string")
    docs = docs.withColumn("span", F.make_interval(days=F.lit(3)))  # a column that Arrow has no batches for
    kept = decontamination.clean(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.select("doc_id", F.col("span").cast("string")).collect()) == [2, 3]


def near_copies(rows):
    """Ids that are not the smallest of their group: five words, similarity 0.8 or more."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for (a, _), x in zip(rows, sets):
            for (b, _), y in zip(rows, sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return {i for i in group if group[i] != i}


def stage(name, spark, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages(spark, tmp_path):
    rng = random.Random(5)
    rows = labelled(n=200)
    items = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"]) for _ in range(30))) for i in range(3)]
    texts = {i: t for i, t, _ in rows}
    for i in range(1, 41, 2):
        texts[i] = prose(rng, 120)
    texts[3] = texts[1]
    texts[7] = texts[5].replace("river", "stream", 1)
    texts[9] = f"{prose(rng, 40)} {items[1][1]} {prose(rng, 40)}"
    texts[11] = f"{prose(rng, 60)} password: abcdefghijklmnop {prose(rng, 60)}"
    spark.createDataFrame([(i, t, "en", f"s{i % 4}", len(t), 1) for i, t in texts.items()],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint, found int").write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, rows).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    good = stage(names[0], spark, docs, str(tmp_path)).cache()
    assert good.columns == docs.columns and ids(good) >= {i for i, _, y in rows if y == 1} - {9, 11}
    assert sum(i % 2 == 0 for i in ids(good)) <= 5
    one = stage(names[1], spark, docs, str(tmp_path)).cache()
    assert one.columns == docs.columns and ids(one) == set(texts) - near_copies(sorted(texts.items()))
    assert not {3, 7} & ids(one)
    clean = stage(names[2], spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and ids(clean) == set(texts) - {9}
    hidden = stage(names[3], spark, docs, str(tmp_path))
    assert hidden.columns == docs.columns
    for r in hidden.collect():
        marked = any(len(m[x.group]) >= x.least for x in secrets.BASE for m in re.finditer(x.pattern, texts[r.doc_id]))
        assert r.n_chars == len(r.text) and (r.text != texts[r.doc_id] if marked else r.text == texts[r.doc_id])
    assert "abcdefghijklmnop" not in {r.doc_id: r.text for r in hidden.collect()}[11]
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in whole} <= ids(good) - {3, 7, 9} and all(0 < r.taken <= 2 * r.size for r in whole)


def test_stages_of_awkward_rows(spark, tmp_path):
    docs = documents(spark).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long")).cache()
    labels(spark, labelled(n=20)).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this is in any of the documents at all")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, function in corpus_pipeline.STAGES[1:-1]:
        assert function(spark, docs, str(tmp_path)).columns == docs.columns, name
        assert function(spark, docs.limit(0), str(tmp_path)).collect() == [], name
    assert stage("benchmark decontamination", spark, docs, str(tmp_path)).count() == docs.count()
    assert stage("secret scans", spark, docs, str(tmp_path)).count() == docs.count()
