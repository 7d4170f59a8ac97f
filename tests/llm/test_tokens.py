import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest

from lithos.llm import byte_bpe, token_counts, token_files
from tests.llm.helpers import documents, rows

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def test_counts_are_the_librarys(spark, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(documents(spark, rows()), WORD).collect())
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows())
    assert got == want


def test_counts_of_nothing(spark):
    assert token_counts.token_counts(documents(spark, []), WORD).collect() == []


def test_files_round_trip(spark, library, tmp_path):
    files = token_files.write_token_files(documents(spark, rows()), str(tmp_path / "t"), WORD, end_id=1)
    got = token_files.read_token_files(spark, files.path).orderBy("start").collect()
    order = sorted(rows(), key=lambda r: -1 if r[0] is None else r[0])
    assert [r.doc_id for r in got] == [i for i, _ in order]
    texts = {}
    for i, t in rows():
        texts.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids in texts[r.doc_id]
        at += len(ids)


def test_files_short_access_and_no_rows(spark, library, tmp_path):
    token_files.write_token_files(documents(spark, rows()), str(tmp_path / "a"), WORD, end_id=None)
    got = token_files.read_documents(spark, str(tmp_path / "a"), [7, 11]).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == {i: library.encode(dict(rows())[i], add_special_tokens=False).ids for i in (7, 11)}
    empty = token_files.write_token_files(documents(spark, []), str(tmp_path / "b"), WORD, end_id=1)
    assert token_files.read_token_files(spark, empty.path).collect() == []


def test_files_refuse_another_dictionary(spark, tmp_path):
    path = str(tmp_path / "t")
    token_files.write_token_files(documents(spark, rows()), path, WORD)
    spark.createDataFrame([("0" * 64, b"other")], "dictionary_sha256 string, dictionary binary").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        token_files.read_token_files(spark, path)


def test_wide_ids_and_crc():
    for ids in (np.array([], np.uint32), np.array([1, 65535], np.uint32), np.array([70_000, 3], np.uint32)):
        assert token_files.deserialize(token_files.serialize(ids)).tolist() == ids.tolist()
    assert token_files.crc32_of(np.array([1, 2])) == zlib.crc32(b"\1\0\0\0\2\0\0\0")


def test_byte_bpe_is_tiktokens(spark):
    import tiktoken

    tokens = byte_bpe.read_ranks(BYTE)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    encoded = byte_bpe.byte_bpe_encode(documents(spark, rows()), BYTE, public_tokenizers.PATTERN, offsets=True, keep=["lang"])
    decoded = byte_bpe.byte_bpe_decode(encoded.drop("char_starts"), BYTE, keep=["lang"]).collect()
    once = byte_bpe.byte_bpe_round_trip(documents(spark, rows()), BYTE, public_tokenizers.PATTERN, keep=["lang"])
    assert sorted(map(str, once.collect())) == sorted(map(str, decoded))
    texts = {(str(i), hashlib.sha256((t or "").encode()).hexdigest()): t or "" for i, t in rows()}
    assert len(decoded) == len(rows())
    for r in decoded:
        text = texts[str(r.doc_id), hashlib.sha256(r.decoded).hexdigest()]
        assert np.frombuffer(r.ids, "<u4").tolist() == want.encode_ordinary(text) and r.lang == "en"
    for r in encoded.where("doc_id = 7").collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.char_starts == want.decode_with_offsets(ids)[1]


def test_byte_bpe_of_nothing(spark):
    assert byte_bpe.byte_bpe_decode(byte_bpe.byte_bpe_encode(documents(spark, []), BYTE, public_tokenizers.PATTERN), BYTE).collect() == []
