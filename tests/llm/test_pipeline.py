"""Every stage of the pipeline against a brute-force version of it, each on its own input."""

import zlib

import numpy as np

import corpus_pipeline as cp
from broadsheet.llm import mixing as mx
from broadsheet.llm import quality_rules as qr
from broadsheet.llm import token_files as tf
from broadsheet.llm import words as wd
from broadsheet.llm.registered import quality_weights, vocabulary
from tests.llm.edges import documents as edge_documents
from tests.llm.test_decontaminate import plain_hits
from tests.llm.test_near_copies import grouped, plain_groups
from tests.llm.test_quality import plain_counts


def stage(spark, tmp_path, name, docs, sf_dir):
    path = str(tmp_path / name)
    dict(cp.STAGES)[name](spark, docs, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, tmp_path, documents, small):
    assert [n for n, _ in cp.STAGES] == ["quality rules", "near duplicates", "decontamination", "source mixing", "token files"]
    frames = [documents]
    for name, _ in cp.STAGES:
        frames.append(stage(spark, tmp_path, name, frames[-1], small))
    assert all(f.columns == documents.columns for f in frames[:-1])
    given = [{r.doc_id: r.text for r in f.collect()} for f in frames[:-1]]

    model, known = qr.train(documents, spark.read.parquet(f"{small}/labels.parquet")), wd.WordHashes()
    good = set()
    for d, t in given[0].items():
        n, _, _, _, repeated = plain_counts(t)
        if n >= 50 and 100 * repeated <= 50 * n and model.probability(qr.features(t, known)) >= qr.THRESHOLD:
            good.add(d)
    assert given[1].keys() == good

    rows = sorted(given[1].items())
    assert given[2].keys() == {rows[min(g)][0] for g in grouped(plain_groups(rows))}

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert given[3].keys() == given[2].keys() - {d for d, _ in plain_hits(list(given[2].items()), bench)}

    drawn = {r.doc_id: r.copies for r in mx.drawn(frames[3], quality_weights(spark, small)).collect()}
    mixed = sorted(r.doc_id for r in frames[4].collect())
    assert mixed == sorted(d for d, n in drawn.items() for _ in range(n))

    encoder, start, got = tf.Encoder(vocabulary()), 0, sorted(frames[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == mixed
    for r in got:
        ids = encoder.tokenizer.encode(given[4][r.doc_id], add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(map(tuple, cp.run(spark, small).collect())) == sorted(map(tuple, got))


def test_stages_stand_odd_and_empty_tables(spark, tmp_path, small):
    docs = edge_documents(spark)
    for name, frame in (("odd", docs), ("empty", docs.filter("false"))):
        for k, (step, function) in enumerate(cp.STAGES):
            out = function(spark, frame, small)
            rows = out.count()
            assert k == len(cp.STAGES) - 1 or out.columns == docs.columns
            assert rows > 0 or name == "empty" or step in ("quality rules",)
