"""The pipeline against plain Python on a small table with nulls, empty, long and repeated texts and extra, clashing columns."""

import random
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as p
from tests.llm.test_classifiers import plain_quality, plain_score, prose
from tickloom.llm import quality, toxicity
from tickloom.llm.common import stage


def documents():
    rng = random.Random(21)
    docs = []
    for i in range(360):
        text = prose(rng, rng.choice([30, 80, 160]))
        if i % 4 == 0:
            text = " | ".join(text.split()).upper()
        if i % 5 == 0:
            words = text.split()
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["grumflix", "zomblat", "quibjerk"]))
            text = " ".join(words)
        docs.append([i, text])
    labels = [(i, int(i % 5 == 0), int(i % 4 != 0)) for i in range(360)]
    items = [(k, prose(rng, n)) for k, n in enumerate([14, 25, 40])] + [(7, "thon anre"), (8, None)]
    for i in range(1, 60, 7):  # passages of the benchmark
        docs[i][1] += " " + items[i % 3][1]
    for i in range(2, 120, 9):  # exact and near copies
        docs.append([1000 + i, docs[i][1]])
        words = docs[i][1].split()
        words[len(words) // 2] = "changed"
        docs.append([2000 + i, " ".join(words).upper().lower()])
    docs += [[3000, None], [3001, ""], [3002, "\n\t "], [None, docs[3][1]], [None, None], [6, docs[6][1]], [3003, prose(rng, 40_000)], [3004, "word"]]
    return docs, labels, items


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def windows(text, n=10):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    docs, labels, items = documents()
    sf = str(tmp_path_factory.mktemp("plain"))
    rows = [(i, t, "la", "s", len(t or ""), 1.0, None) for i, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, y int").repartition(3)
    df.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels + [(5, 0, 1), (None, 1, 0), (9999, 1, 0)], "doc_id long, toxic long, quality long").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), items, sf


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_equal_plain_python(spark, corpus):
    docs, labels, items, sf = corpus
    stages = dict(p.STAGES)
    columns = docs.columns

    seen, model = pairs(docs), quality.fit(docs, labels)
    docs = stage(stages["quality"](spark, docs, sf), "plain")
    now = pairs(docs)
    assert docs.columns == columns and now == [x for x in seen if plain_quality(x[1], model) >= 0.5]
    assert len(now) > 200 and not {i for i, _ in now if i is not None and i < 360 and i % 4 == 0}

    seen, model = now, toxicity.fit(docs, labels)
    docs = stage(stages["toxicity"](spark, docs, sf), "plain")
    now = pairs(docs)
    assert now == [x for x in seen if plain_score(x[1], model) < 0.5]
    assert len(now) > 150 and not {i for i, _ in now if i is not None and i < 360 and i % 5 == 0}

    seen = now
    docs = stage(stages["near_dedup"](spark, docs, sf), "plain")
    now = pairs(docs)
    grams, root = [sets(t) for _, t in seen], list(range(len(seen)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(seen)):
        for b in range(a):
            if grams[a] == grams[b] or 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(seen):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    ids = [i for i, _ in now]
    assert sorted(i for i in ids if i is not None) == sorted(set(least.values()))
    assert ids.count(None) == sum(i is None for i, _ in seen)
    assert {x for x in now} <= set(seen)

    seen = now
    docs = stage(stages["decontamination"](spark, docs, sf), "plain")
    now = pairs(docs)

    def contaminated(text):
        words, own = windows(text)
        for _, item in items:
            w, ten = windows(item)
            if ten & own or (0 < len(w) < 10 and tuple(w) in windows(text, len(w))[1]):
                return True
        return False

    assert now == [x for x in seen if not contaminated(x[1])] and len(now) < len(seen)

    packed = stages["packing"](spark, docs, sf)
    lengths = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert lengths.where("doc_id is not null and n <> all").count() == 0 and lengths.count() == len({i for i, _ in now})


def test_run_equals_its_stages(spark, corpus):
    _, _, _, sf = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, apply in p.STAGES:
        docs = stage(apply(spark, docs, sf), name)
    key = lambda df: sorted(map(str, df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    assert key(p.run(spark, sf)) == key(docs)


def test_empty_tables(spark, corpus, tmp_path):
    docs, labels, _, _ = corpus
    sf = str(tmp_path)
    docs.limit(0).write.parquet(f"{sf}/documents.parquet")
    labels.limit(0).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert p.run(spark, sf).collect() == []
