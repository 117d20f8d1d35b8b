import zlib

import numpy as np

from rows import documents, empty, texts
from staylens.llm.quality_cnn import Network, accepted, gradients, chunk_rows, chunk_starts, scored


def labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [("ZAP!!" if bad else "calm") + "abcdefgh"[(i * 7 + k) % 8] for k in range(30 + i % 50)]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0 if bad else 1, 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    found = scored(docs, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    tested = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in tested]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    left = accepted(docs, labels)
    assert left.dtypes == docs.dtypes
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in found if r["predicted"]}


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = labelled(spark, 120)
    from pyspark.sql import functions as F

    flipped = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = ({r["doc_id"]: r["score"] for r in scored(docs, which).collect()} for which in (labels, flipped))
    assert one == two


def test_awkward_rows(spark):
    docs, labels = labelled(spark, 80)
    assert scored(documents(spark), labels).count() == len(texts())
    assert scored(empty(spark), labels).count() == 0
    none = scored(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r[0] for r in none] == [0.5]
    ones = {r[0] for r in scored(docs, labels.where("quality = 1")).select("score").collect()}
    assert len(ones) == 1 and 0.9 < ones.pop() < 1


def test_chunks_cover_the_text():
    for size in (0, 1, 511, 512, 513, 5000):
        seen = np.zeros(size, bool)
        for s in chunk_starts(size):
            seen[s : s + 512] = True
        assert seen.all()


def test_gradients():
    net, rng = Network.fresh(), np.random.default_rng(0)
    net.out[:] = rng.normal(size=net.out.shape)
    texts_ = [rng.integers(60, 120, n).astype(np.uint8) for n in (900, 300)]
    chunks = np.concatenate([chunk_rows(t, chunk_starts(len(t))) for t in texts_])
    first, label, weight = np.array([0, len(chunk_starts(900))]), np.array([1.0, 0.0]), np.ones(2)

    def loss():
        p = net.combined(net.features(chunks), first)
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    for w, g in zip(net.weights, gradients(net, chunks, first, label, weight)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = w[at], 1e-2
        w[at] = keep + step
        high = loss()
        w[at] = keep - step
        low = loss()
        w[at] = keep
        assert abs((high - low) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_filters_meet_every_byte():
    """One byte more in front of a text leaves the largest responses inside a chunk as they are."""
    import numpy as np

    from staylens.llm.quality_cnn import Network, chunk_rows

    at = np.zeros(1, np.int64)
    text = np.frombuffer(b"z" * 99 + b"pattern!" + b"z" * 99, np.uint8)
    more = np.concatenate([text[:1], text])
    one, two = (Network.fresh().responses(chunk_rows(t, at))[0] for t in (text, more))
    assert np.allclose(one, two, atol=1e-4)
