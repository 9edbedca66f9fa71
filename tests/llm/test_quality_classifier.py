"""The byte network against a plain convolution, its gradient against differences, and the query on held-out labels."""

import os
import zlib

import numpy as np
import pytest

pytest.importorskip("tablewright.llm")

from tablewright.llm import quality_classifier as Q  # noqa: E402


def plain_logit(net, chunk):
    pooled = np.full(Q.FILTERS, -np.inf)
    for at in range(0, Q.CHUNK - Q.WIDTH + 1, 2):
        window = net.vectors[chunk[at : at + Q.WIDTH]].reshape(-1)
        pooled = np.maximum(pooled, window @ net.filters.reshape(-1, Q.FILTERS))
    inner = np.maximum(np.maximum(pooled + net.bias, 0) @ net.hidden + net.hidden_bias, 0)
    return inner @ net.out + net.out_bias[0]


def test_network_is_the_convolution():
    net, draw = Q.Network.new(4), np.random.default_rng(5)
    chunks = draw.integers(0, 256, (Q.SLICE + 7, Q.CHUNK), dtype=np.uint8)
    assert np.allclose(net.logits(chunks)[-9:], [plain_logit(net, c) for c in chunks[-9:]], atol=1e-4)


def test_slopes_are_those_of_the_loss():
    net, draw = Q.Network.new(4), np.random.default_rng(5)
    chunks = draw.integers(0, 256, (6, Q.CHUNK), dtype=np.uint8)
    labels, care = np.array([0, 1, 1, 0, 1, 0], np.float32), np.array([1, 2, 1, 0.5, 1, 1], np.float32)
    for part, slope in zip(net.parts(), net.slopes(chunks, labels, care), strict=True):
        part[...] = part.astype(np.float64)
        assert part.shape == slope.shape
        for at in [tuple(draw.integers(0, s) for s in part.shape) for _ in range(12)]:
            old, loss = part[at], []
            for d in (0.002, -0.002):
                part[at] = old + d
                z = np.array([plain_logit(net, c) for c in chunks], float)
                loss.append((care * (np.logaddexp(0, z) - labels * z)).sum())
            part[at] = old
            assert abs((loss[0] - loss[1]) / 0.004 - slope[at]) < 0.02 + 0.05 * abs(slope[at])


def test_chunks_cover_all_bytes():
    for size in (0, 1, Q.CHUNK - 1, Q.CHUNK, Q.CHUNK + 1, Q.CHUNK + Q.STEP, Q.CHUNK + Q.STEP + 1, 5000):
        raw = bytes(np.random.default_rng(size).integers(1, 256, size, dtype=np.uint8))
        found = Q.chunks_of(raw)
        assert len(found) == Q.chunk_count(size) and (len(found) - 1) * Q.STEP + Q.CHUNK >= size
        for at in range(0, max(1, size - Q.WIDTH + 1), 7):  # each window of a filter lies within some chunk
            window = np.frombuffer(raw[at : at + Q.WIDTH], np.uint8)
            assert any(0 <= at - k * Q.STEP <= Q.CHUNK - len(window) and (c[at - k * Q.STEP :][: len(window)] == window).all() for k, c in enumerate(found))
    assert len(Q.chunks_of(b"x" * 90_000, 24)) == 24


def test_scores_do_not_depend_on_company():
    net = Q.Network.new(4)
    model = Q.Model(net, np.array([0.1, 1.0, 0.5, 0.5]))
    texts = [b"", b"short", b"some words " * 40, b"x" * 70_000, b"\x00\xff" * 300]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts], atol=1e-5)


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("no driver tables here")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = Q.query(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [(label[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in label]
    assert len(judged) > 80
    assert sum(a == b for a, b in judged) / len(judged) >= 0.95


def test_odd_rows_and_labels(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None), (2, ""), (2, ""), (3, "word " * 30), (4, "Ok. " * 20)], "doc_id long, text string").selectExpr("*", "1 AS score", "'x' AS raw", "2 AS quality")
    labels = spark.createDataFrame([(1, 1), (3, None), (4, 0), (4, 1), (None, 1), (3, 1)], "doc_id long, quality int").selectExpr("*", "'x' AS text")
    known = [k for k in (1, 3, 4) if zlib.crc32(str(k).encode()) % 3 != 1]
    assert known
    out = Q.score(docs, Q.fit(docs, labels))
    assert out.columns == ["doc_id", "score", "predicted"] and sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 2, 3, 4]
    assert {r.score for r in Q.score(docs, Q.fit(docs, labels.where("doc_id = 9"))).collect()} == {0.5}
    assert Q.score(docs.where("doc_id = 9"), Q.fit(docs, labels)).count() == 0
