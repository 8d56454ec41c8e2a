"""Token files: the library's own ids, exact round trips, damage."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import ans
from broadsheet.llm import token_files as tf
from broadsheet.llm.registered import vocabulary
from tests.llm.edges import documents as edge_documents


@pytest.fixture(scope="module")
def encoder():
    return tf.Encoder(vocabulary())


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), encoder.dtype).tolist()


def want(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab Z \n\t\r'.,1\x1c\x85\xa0é漢ª²́ \x00ɏɐ😀")) | st.characters(codec="utf-8"), max_size=30))
def test_any_text_has_the_librarys_ids(text):
    e = tf.Encoder(vocabulary())
    assert ids(e, text) == want(e, text)


def test_mixed_white_space_and_special_tokens(encoder):
    rng = random.Random(10)
    parts = ["a", "b ", " ", "  ", "\n", " \n", "\t", "it's", "<|endoftext|>", "x<|endo", "1,000", "\x85", "é", "."]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert ids(encoder, text) == want(encoder, text)


def test_whole_table(spark, documents, encoder, tmp_path):
    tf.write(documents, str(tmp_path / "t"), vocabulary(), segment=20_000)
    got = {r.doc_id: r for r in tf.read(spark, str(tmp_path / "t")).collect()}
    start = 0
    for r in documents.orderBy("doc_id").collect():
        all_ids = want(encoder, r.text or "") + [0]
        row = got[r.doc_id]
        assert (row.start, row.n_tokens, row.ids) == (start, len(all_ids), all_ids)
        assert row.ids_crc32 == zlib.crc32(np.array(all_ids, "<u4").tobytes())
        start += len(all_ids)
    assert len(got) == documents.count()


def test_edges(spark, encoder, tmp_path):
    docs = edge_documents(spark)
    tf.write(docs, str(tmp_path / "e"), vocabulary(), segment=1000)
    rows = sorted(tf.read(spark, str(tmp_path / "e")).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    texts = sorted((repr(r.doc_id), want(encoder, r.text or "") + [0]) for r in docs.collect())
    assert sorted((repr(r.doc_id), r.ids) for r in rows) == texts
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    tf.write(docs.filter("false"), str(tmp_path / "n"), vocabulary())
    assert tf.read(spark, str(tmp_path / "n"), with_ids=False).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 32_768, 65_535, 65_536, 65_537, 140_001])
def test_round_trip_of_blocks(n):
    rng = np.random.default_rng(n)
    values = np.minimum(rng.geometric(0.01, n), 60_000).astype(np.uint16)
    symbols, share = ans.frequencies(values)
    blocks = ans.encode(values, symbols, share)
    assert share.sum() == 1 << ans.SCALE and share.min() >= 1 and (ans.decode(blocks, symbols, share) == values).all()
    assert (ans.decode(blocks[1:], symbols, share) == values[ans.BLOCK:]).all()  # blocks need no other block


def test_many_rare_symbols_and_size():
    values = np.concatenate([np.arange(50_257), np.zeros(2_000_000, int)]).astype(np.uint16)
    symbols, share = ans.frequencies(values)
    assert share.min() >= 1 and share.sum() == 1 << ans.SCALE
    assert (ans.decode(ans.encode(values[:70_000], symbols, share), symbols, share) == values[:70_000]).all()
    rng = np.random.default_rng(0)
    skewed = rng.choice(8, 200_000, p=[.6, .2, .1, .05, .02, .01, .01, .01]).astype(np.uint16)
    p = np.bincount(skewed) / len(skewed)
    bits = 8 * sum(len(b["words"]) for b in ans.encode(skewed, *ans.frequencies(skewed))) / len(skewed)
    assert bits < -(p * np.log2(p)).sum() + 0.05


def test_damage_is_found():
    payload = bytearray(tf.pack([1, None], [70_000, 2], np.arange(70_002, dtype=np.uint16) % 500))
    assert tf.unpack(bytes(payload))[0] == [1, None]
    for at in (0, 25, len(payload) - 3):
        broken = payload.copy()
        broken[at] ^= 1
        with pytest.raises(ValueError):
            tf.unpack(bytes(broken))
