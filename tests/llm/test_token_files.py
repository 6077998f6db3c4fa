"""Token files against the plain tokenizer, and what they do with damage."""

import random
import zlib

import numpy as np
import pytest

from regtables.llm import rans, token_files
from regtables.llm.tokens import Encoder


def cases():
    rng = random.Random(4)
    docs = [(i * 2, " ".join(rng.choice(["a", "été", "word,", "  x", "日本", "straße."]) for _ in range(rng.choice([0, 1, 9, 300])))) for i in range(120)]
    rng.shuffle(docs)
    return docs + [(1, None), (3, ""), (-5, "first"), (9, "long one " * 20_000)]


def wanted(docs):
    tokenizer, found, start = Encoder().tokenizer, [], 0
    for i, t in sorted(docs, key=lambda d: d[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        found.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@pytest.mark.parametrize("block_tokens", [100, 1 << 16])
def test_round_trip(spark, block_tokens):
    docs = cases()
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, shard int, start int").repartition(5)
    got = token_files.token_digests(d, block_tokens=block_tokens).collect()
    assert sorted(tuple(r) for r in got) == wanted(docs)


def test_ids_and_damage(spark, tmp_path):
    d = spark.createDataFrame([(1, "some words"), (None, "no id"), (1, "some words")], "doc_id long, text string")
    folder = str(tmp_path / "files")
    token_files.write_token_files(d, folder)
    ids = Encoder().tokenizer.encode("some words", add_special_tokens=False).ids + [2]
    rows = token_files.read_token_ids(spark, folder).collect()
    assert [r.ids for r in rows if r.doc_id == 1] == [ids, ids] and len(rows) == 3
    block = spark.read.parquet(f"{folder}/blocks").first().asDict()
    table = rans.Table(token_files._frequencies(spark.read.parquet(f"{folder}/table")))
    import pyarrow as pa

    block["states"] = bytes([block["states"][0] ^ 1]) + bytes(block["states"][1:])
    with pytest.raises(ValueError, match="damaged"):
        list(token_files._checked([pa.RecordBatch.from_pylist([block])], table))


def test_empty_table(spark):
    assert token_files.token_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_units_give_the_tokenizers_ids():
    texts = ["", " ", "  a  b ", "a \n b\n\nc  ", "x\0y  z", "日本語 テキスト é² ½a's it's", "<|endoftext|> a", "\xa0a  b", "don't we'll  ", "a\x1c b", " lead", "tab\t b"]
    small = Encoder(kept=5)
    for e in (Encoder(), small, small):
        for t in texts:
            assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_special_tokens_have_their_own_id(spark):
    from tokenizers import Tokenizer

    from regtables.llm import packing, token_counts
    from regtables.llm.tokens import tokenizer_file

    plain = Tokenizer.from_file(tokenizer_file())
    texts = ["a <|endoftext|> b", "plain  text", "<|endoftext|>", "x  <|endoftext|><|endoftext|>  y\n<|endoftext", "", "many words " * 200 + "a  <|endoftext|>\n b"]
    ids = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder().encode(texts)] == ids
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    ends = np.cumsum([len(x) + 1 for x in ids]).tolist()
    assert sorted(tuple(r) for r in token_files.token_digests(d).collect()) == [(i, e - len(x) - 1, len(x) + 1, crc([*x, 2])) for i, (x, e) in enumerate(zip(ids, ends))]
    assert sorted((r.doc_id, r.length, r.ids_crc32) for r in packing.packed(d).collect()) == [(i, len(x) + 1, crc([*x, 0])) for i, x in enumerate(ids)]
    assert sorted((r.doc_id, r.tokens_before) for r in token_counts.revised_counts(d).collect()) == [(i, len(x)) for i, x in enumerate(ids)]


def test_lanes_checkpoints_and_rare_ids():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.2, 200_000), 50_000).astype(np.uint32)
    blocks = [*np.split(ids, np.sort(rng.integers(0, len(ids), 12))), ids[:0], ids[:1], ids[:64], ids[:65]]
    table = rans.Table.from_counts(np.bincount(ids))
    coded = [(*c, len(b)) for c, b in zip(rans.encode(blocks, table), blocks)]
    assert all((a == b).all() for a, b in zip(rans.decode(coded, table), blocks))
    assert all((rans.decode([c], table)[0] == b).all() for c, b in zip(coded, blocks))
    # A stretch decodes without what stands before its checkpoint.
    words, states, places, n = max(coded, key=lambda c: c[3])
    p = np.frombuffer(places, "<i8")
    if len(p) > 1:
        part = words[4 * p[1] :], states[8 * rans.LANES :], (p[1:] - p[1]).astype("<i8").tobytes(), n - rans.CHECKPOINT_STEPS * rans.LANES
        whole = max(blocks, key=len)
        assert (rans.decode([part], table)[0] == whole[rans.CHECKPOINT_STEPS * rans.LANES :]).all()
