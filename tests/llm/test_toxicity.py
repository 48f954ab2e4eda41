import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terrametry.llm import toxicity

from .conftest import prose


def test_scores_find_held_out_toxic_texts(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        words = prose(rng, rng.randint(3, 60)).split(" ")
        toxic = k % 4 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(["fool", "rotten", "zzgrim" + rng.choice(["on", "er"])]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    net = toxicity.fit(docs, known)
    score = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    held = [(score[k], y) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([a > b for a in bad for b in good]) > 0.95
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9
    assert all(0 <= s <= 1 for s in score.values())


def test_odd_rows_score_and_long_texts_are_read_whole(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(3, 1)], "doc_id long, toxic int")
    net = toxicity.fit(odd_docs, labels)
    found = toxicity.score(odd_docs, net).collect()
    assert len(found) == len(odd_rows) and all(r.score < 0.5 for r in found)
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0


def test_blocks_do_not_change_scores(monkeypatch):
    rng = random.Random(2)
    texts = pa.array([prose(rng, n) for n in (0, 1, 2, 50, 700)] + [None])
    net = toxicity.Network.fresh()
    rows, first = toxicity.word_buckets(texts)
    whole = net.scores(rows, first, net.word_table())
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    assert np.allclose(whole, net.scores(rows, first, net.word_table()))
    x = net.embedding[np.concatenate([rows[first[3]:first[4]], np.full((2, 3), toxicity._PAD)])].sum(1)
    direct = max(float((x[i] @ net.filters[1][0] + x[i + 1] @ net.filters[1][1])[0]) for i in range(50))
    pooled = net.pooled(rows, first, net.word_table())[3, toxicity.FILTERS]
    assert np.isclose(pooled, max(direct, 0), atol=1e-5)


def test_languages():
    texts = pa.array(["the cat is of", "le chat est dans", "der hund und die", "el gato y los", "xyz", ""])
    assert toxicity.languages(*toxicity.word_buckets(texts)).tolist() == [1, 2, 3, 4, 0, 0]


def test_a_repeated_labelled_id_is_one_text(spark):
    """The same model, whether a labelled id occurs once or many times, and with whatever other texts."""
    rng = random.Random(6)
    rows = [(k, prose(rng, 20) + (" vile rot" if k % 3 == 0 else "")) for k in range(60)]
    known = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    more = rows + [(k, "\uffff " + t) for k, t in rows] * 3
    nets = [toxicity.fit(spark.createDataFrame(r, "doc_id long, text string"), known) for r in (rows, more)]
    assert np.array_equal(nets[0].embedding, nets[1].embedding) and np.array_equal(nets[0].thresholds, nets[1].thresholds)


def test_labelled_rows_beyond_any_sample_are_learned(spark):
    """A word that only texts late in the order of hashed ids hold is learned all the same."""
    ids = [r.id for r in spark.range(16_000).where(toxicity.fold("id") != 0).orderBy(F.xxhash64("id"), "id").collect()]
    rng = random.Random(9)
    late, rows, labels = set(ids[12_000:]), [], []
    for place, k in enumerate(ids):
        toxic = place % 4 == 0
        word = ("vilest" if k in late else "rotten") if toxic else "gentle"
        rows.append((k, f"{prose(rng, 3)} {word} {prose(rng, 2)}"))
        labels.append((k, int(toxic)))
    new = [(100_000 + i, f"{prose(rng, 3)} {word} {prose(rng, 2)}") for i in range(50) for word in ("vilest",)]
    docs = spark.createDataFrame(rows + new, "doc_id long, text string")
    net = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = toxicity.score(docs.where("doc_id >= 100000"), net).collect()
    assert len(found) == 50 and np.mean([r.score >= 0.5 for r in found]) > 0.9


def test_every_labelled_text_is_in_one_shard(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 40)
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.randint(0, 9))) for k in range(400)] + [(None, "x"), (7, "zz again"), (8, None)]
    known = [(k, k % 2) for k in range(0, 400, 2)] + [(7, 1), (8, 1), (None, 1), (5000, 1)]
    shards = toxicity._labelled_shards(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, toxic int"),
        "doc_id", "text", "toxic").collect()
    assert len({r.shard for r in shards}) > 2
    got = {}
    for r in shards:
        ids, labels, texts, kinds = toxicity._unpacked(r.asDict())
        assert not got.keys() & set(ids.tolist())
        got |= {k: (r.fitting, int(y), kinds[t].tolist()) for k, y, t in zip(ids.tolist(), labels, texts)}
    want, best = {}, dict(known)
    for k, text in sorted(((k, t) for k, t in rows if k is not None and t is not None), reverse=True):
        at = zlib.crc32(str(k).encode()) % 5
        if k in best and at:
            want[k] = (at != 4, max(y for i, y in known if i == k), toxicity.word_buckets(pa.array([text]))[0].tolist())
    assert got == want


def test_thresholds_are_the_best_over_all_texts(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2]), k, rng.choice([-1.0, 0.25, 0.5, rng.uniform(-3, 3)]), rng.randint(0, 1)) for k in range(700)]
    rows += [(3, 1000 + k, float(k), 1) for k in range(5)] + [(4, 2000 + k, float(k), 0) for k in range(5)]
    found = {r.spoken: r for r in toxicity.best_thresholds(
        spark.createDataFrame(rows, "spoken int, id long, logit float, label int").repartition(7)).collect()}
    for kind in (1, 2, 3, 4):
        own = sorted((x, k, y) for s, k, x, y in rows if s == kind)
        x = [float(np.float32(v)) for v, _, _ in own]
        wrong = [sum(y == 1 for _, _, y in own[:k]) + sum(y == 0 for _, _, y in own[k:]) for k in range(len(own) + 1)]
        best = [k for k, w in enumerate(wrong) if w == min(wrong)]
        padded = [x[0] - 1, *x, x[-1] + 1]
        want = np.mean([(padded[k] + padded[k + 1]) / 2 for k in (best[0], best[-1])])
        r = found[kind]
        assert np.isclose(r.threshold, want) and r.n == len(own) and (r.least, r.most) == (min(y for *_, y in own), max(y for *_, y in own))


def test_shards_average_what_they_touched():
    rows = [{"shard": 1, "n": 1, "part": 0, "ids": np.array([3, 5], np.int32).tobytes(), "own": np.repeat(np.float32([1, 2]), toxicity.WIDTH + 1).tobytes()},
            {"shard": 0, "n": 3, "part": 0, "ids": np.array([5], np.int32).tobytes(), "own": np.repeat(np.float32([6]), toxicity.WIDTH + 1).tobytes()}]
    out = toxicity._averaged(pa.Table.from_pylist(rows, pa.schema([
        ("shard", pa.int32()), ("n", pa.int64()), ("part", pa.int32()), ("ids", pa.binary()), ("own", pa.binary())]))).to_pylist()[0]
    assert np.frombuffer(out["ids"], np.int32).tolist() == [3, 5]
    assert np.frombuffer(out["own"], np.float32).reshape(2, -1)[:, 0].tolist() == [1.0, 5.0]


def test_a_shards_rows_stay_small_and_meet_without_a_shuffle(spark, monkeypatch):
    """Rows do not grow with the shard, a task gets few of them at once, and the network is that of one row a shard."""
    rng = random.Random(11)
    docs = spark.createDataFrame([(k, prose(rng, rng.randint(0, 9))) for k in range(300)], "doc_id long, text string")
    known = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SHARD", 100)
    nets, batch_rows = [], spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for piece in (10, 1000):
        monkeypatch.setattr(toxicity, "PIECE", piece, raising=False)
        shards = toxicity._labelled_shards(docs, known, "doc_id", "text", "toxic")
        if piece == 10:
            sizes = [r.n for r in shards.collect()]
            assert max(sizes) < 40 and sum(sizes) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(300))
            together = shards.groupBy("fitting", "shard").agg(F.sum("n"))
            assert "Exchange" not in together._jdf.queryExecution().executedPlan().toString()
        nets.append(toxicity.train(shards.where("fitting"), np.float32(0.5)))
    assert np.array_equal(nets[0].embedding, nets[1].embedding) and np.array_equal(nets[0].weights, nets[1].weights)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == batch_rows
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("labelled_shards_")]
