import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rosterline.llm import id_shards

JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ids():
    known = Tokenizer.from_file(JSON)
    return lambda text: np.array([*known.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def expected(rows, ids):
    out, start = [], 0
    for key, text in rows:
        found = ids(text)
        out.append((key, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    return out


def plain(df, id="doc_id"):
    return sorted(((r[id], r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("shard_bytes", [1 << 30, 20_000])
def test_documents_against_brute_force(documents, ids, shard_bytes):
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    assert plain(id_shards.encoded(documents, JSON, shard_bytes=shard_bytes)) == expected(rows, ids)


def test_awkward_rows(spark, awkward, ids):
    got = plain(id_shards.encoded(awkward, JSON))
    assert len(got) == awkward.count()
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for key, _, number, crc in got:
        if key is not None:
            found = ids(texts[key])
            assert (number, crc) == (len(found), zlib.crc32(found.tobytes()))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]])[:-1].tolist()
    assert id_shards.encoded(awkward.limit(0), JSON).count() == 0
    named = awkward.selectExpr("doc_id as key", "text as ids", "1 as shard", "2 as mark", "3 as name", "size as doc_id")
    assert plain(id_shards.encoded(named, JSON, id="key", text="ids"), "key") == got


def test_keyed_access(spark, ids):
    docs = spark.createDataFrame([(f"k{i % 700}", f"text number {i}") for i in range(1000)] + [(None, "nameless"), ("", None)], "doc_id string, text string")
    shards = id_shards.write(docs, JSON)
    assert shards.table.count() > 1
    for key in ("k0", "k5", "k299", "k699"):
        want = sorted(ids(r.text).tolist() for r in docs.filter(docs.doc_id == key).collect())
        assert sorted(f.tolist() for f in shards.get(key)) == want
    assert [f.tolist() for f in shards.get(None)] == [ids("nameless").tolist()] and [f.tolist() for f in shards.get("")] == [[0]]
    assert shards.get("absent") == [] and shards.get("k7000") == []


def test_one_key_of_very_many_rows_is_dealt_to_many_shards(spark, ids):
    docs = spark.createDataFrame([(7 if i % 3 else i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    shards = id_shards.write(docs, JSON)
    most = max(r.records for r in shards.table.collect())
    assert most < 1000 and len(shards.get("7")) == 2000
    rows = plain(id_shards.read(shards))
    assert [r[0] for r in rows] == sorted(r.doc_id for r in docs.collect())


def test_a_file_of_a_failed_attempt_is_not_read(spark, ids):
    import os

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    shards = id_shards.write(docs, JSON)
    with open(os.path.join(shards.folder, "00000000-999999.ids"), "wb") as f:
        f.write(b"half a reco")
    assert plain(id_shards.read(shards)) == expected([(i, f"text {i}") for i in range(50)], ids)


@pytest.mark.parametrize("count", [0, 1, 2, 63, 5000])
def test_the_hash_is_perfect_and_minimal(count):
    keys = [f"key {i}" for i in range(count)]
    hashes = id_shards.key_hashes(keys)
    known = id_shards.PerfectHash.of(hashes)
    assert sorted(known.slots(hashes).tolist()) == list(range(count))
    assert sum(known.sizes) <= 6 * count + 64 * id_shards.LEVELS
    other = known.slots(id_shards.key_hashes([f"other {i}" for i in range(100)]))
    assert ((other >= -1) & (other < max(count, 1))).all()


def test_absent_keys_are_told_by_their_fingerprint(tmp_path):
    keys = [f"key {i}" for i in range(2000)]
    (tmp_path / "s.index").write_bytes(id_shards.index_bytes(keys, [2] * 2000))
    (tmp_path / "s.ids").write_bytes(np.arange(4000, dtype="<u4").tobytes())
    with id_shards.Shard(str(tmp_path), "s") as shard:
        assert shard.get("key 1234")[0].tolist() == [2468, 2469]
        first, copies = shard.find([f"other {i}" for i in range(20_000)])
        assert copies.sum() == 0
        assert [k for k, _, _ in shard.records()] == keys


def test_long_records_and_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(id_shards, "READ_BYTES", 64)
    lengths = [1, 100, 3, 1, 16, 17, 1, 200, 2]
    keys = ["a", "a", "b", "c", "d", "e", "f", "f", "g"]
    (tmp_path / "s.index").write_bytes(id_shards.index_bytes(keys, lengths))
    whole = np.arange(sum(lengths), dtype="<u4")
    (tmp_path / "s.ids").write_bytes(whole.tobytes())
    with id_shards.Shard(str(tmp_path), "s") as shard:
        found = list(shard.records())
    assert [k for k, _, _ in found] == keys and [len(i) for _, _, i in found] == lengths
    assert np.concatenate([i for _, _, i in found]).tolist() == whole.tolist()


def test_long_white_space(spark, ids):
    texts = [" " * 300_000, "a" + "\t" * 200_000 + "b", " " * 150_000, "x" + " \n" * 100_000 + "y <|endoftext|> z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert plain(id_shards.encoded(docs, JSON)) == expected(list(enumerate(texts)), ids)
