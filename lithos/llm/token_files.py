"""Token-id output: one zstandard frame per document under a shared dictionary, with an offset index.

A file set is a Parquet folder, written by Spark's own committer (so lost tasks leave nothing half
done, on any store Spark can write). Each row is a shard of at most ``SHARD_BYTES`` of frames:

- ``part, shard``: range of ids, and order within it;
- ``first_token``: ids of all documents before the shard in its part;
- ``dictionary_sha256``: of the dictionary that its frames need (kept beside, in ``dictionary/``);
- ``doc_ids, n_tokens, offsets``: the index; frame i is ``payload[offsets[i] : offsets[i + 1]]``;
- ``payload``: the frames joined. A frame holds a document's ids as little-endian integers, of 16 bits where
  all of its ids fit and else of 32, after one byte that says which (2 or 4).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.llm._spark import new_path, shuffle_partitions
from lithos.llm._text import ragged_take, sums, text_slices
from lithos.llm.word_pieces import WIDE_SLICE, WordPieces

SHARD_BYTES = 2 << 20
#: The dictionary is trained on so many documents, those of least hash, and so many ids of each at most.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 400, 4000, 32_768

_FRAMES = "part int, id long, n_tokens long, frame binary"
_SHARDS = "part int, shard int, first_token long, part_tokens long, dictionary_sha256 string, doc_ids array<long>, n_tokens array<long>, offsets array<long>, payload binary"


@dataclass
class TokenFiles:
    """A written file set; ``dictionary`` is its shared dictionary (empty where too little text was there to train one)."""

    path: str
    dictionary: bytes


def _ids(pieces: WordPieces, part: pa.RecordBatch, end_id: int | None) -> Iterator[np.ndarray]:
    index, starts, chunks = pieces.frequencies(part.column("text"))
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks)) // 4
    flat = np.frombuffer(b"".join(chunks), np.uint32)
    ids = ragged_take(flat, (np.cumsum(lengths) - lengths)[index], lengths[index])
    ends = np.cumsum(sums(lengths[index], starts))
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    for a, b in zip([0, *ends[:-1]], ends, strict=True):
        yield np.concatenate([ids[a:b], tail])


def serialize(ids: np.ndarray) -> bytes:
    """A width byte (2 or 4), then the ids little-endian in that width."""
    return b"\2" + ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 65536 else b"\4" + ids.astype("<u4").tobytes()


def deserialize(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int | None) -> bytes:
    """A dictionary from a bounded sample of serialized id arrays; empty if the sample can't carry one."""
    chosen = [r[0] for r in docs.select("id").where("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS).collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = WordPieces.of(tokenizer)
        for batch in batches:
            for part in text_slices(batch, limit=WIDE_SLICE):
                out = [serialize(ids[:SAMPLE_IDS]) for ids in _ids(pieces, part, end_id)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(out, pa.binary())], ["id", "sample"])

    if not chosen:
        return b""
    rows = docs.where(F.col("id").isin(chosen)).mapInArrow(run, "id long, sample binary").dropDuplicates(["id"]).collect()
    samples = [bytes(r.sample) for r in sorted(rows, key=lambda r: r.id)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, end_id: int | None = None, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encode every whole text and write the file set at ``path``, documents in ascending ``id_col``.

    One shuffle, of compressed frames: ranges of ids are set beforehand from the id column alone, so
    texts are encoded once. Null texts are empty (only the end id); null ids come first; rows that
    repeat an id all stay, beside each other; other columns are ignored; an empty table makes an
    empty file set.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dictionary = train_dictionary(docs, tokenizer, end_id)
    parts = shuffle_partitions(spark)
    cuts = sorted(set(docs.approxQuantile("id", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    digest = hashlib.sha256(dictionary).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = WordPieces.of(tokenizer)
        press = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        bounds = np.array(cuts, np.float64)
        for batch in batches:
            for part in text_slices(batch, limit=WIDE_SLICE):
                ids = list(_ids(pieces, part, end_id))
                at = np.searchsorted(bounds, np.array([-np.inf if i is None else i for i in part.column("id").to_pylist()]), side="right")
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), part.column("id"), pa.array([len(x) for x in ids], pa.int64()), pa.array([press.compress(serialize(x)) for x in ids], pa.binary())], ["part", "id", "n_tokens", "frame"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, done, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, done, held, size
            ids, counts, frames = zip(*held, strict=True)
            total, first = sum(counts), done
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).tolist()
            row = {"part": part, "shard": shard, "first_token": first, "part_tokens": total, "dictionary_sha256": digest, "doc_ids": list(ids), "n_tokens": list(counts), "offsets": offsets, "payload": b"".join(frames)}
            shard, done, held, size = shard + 1, done + total, [], 0
            types = {"part": pa.int32(), "shard": pa.int32(), "first_token": pa.int64(), "part_tokens": pa.int64(), "dictionary_sha256": pa.string(), "doc_ids": pa.list_(pa.int64()), "n_tokens": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64()), "payload": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in types.items()], list(types))

        for batch in batches:
            for i, n, frame in zip(batch.column("id").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                held.append((i, n, frame))
                size += len(frame)
                if size >= SHARD_BYTES:
                    yield flush()
        if held:
            yield flush()

    frames = docs.mapInArrow(encode, _FRAMES)
    dealt = frames.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(F.col("id").asc_nulls_first(), "n_tokens", "frame")
    dealt.mapInArrow(pack, _SHARDS).write.option("compression", "uncompressed").parquet(f"{path}/shards")
    spark.createDataFrame([(digest, dictionary)], "dictionary_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    return TokenFiles(path, dictionary)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document of a file set; ``ids`` as little-endian 32-bit integers in binary.

    Where each part starts comes from the index columns alone: one sum per part, as many as the
    shuffle partitions it was written with, which is what is broadcast. A frame whose dictionary
    isn't the one kept fails the read.
    """
    shards = spark.read.schema(_SHARDS).parquet(f"{path}/shards")
    kept = spark.read.parquet(f"{path}/dictionary").first()
    digest, dictionary = kept.dictionary_sha256, bytes(kept.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != digest:
        raise ValueError(f"the dictionary in {path} doesn't match its hash")
    totals = sorted((r.part, r.n) for r in shards.groupBy("part").agg(F.sum("part_tokens").alias("n")).collect())
    bases = dict(zip([p for p, _ in totals], np.concatenate([[0], np.cumsum([n for _, n in totals])]).tolist(), strict=False))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dictionary_sha256"] != digest:
                    raise ValueError(f"shard {row['shard']} of part {row['part']} needs another dictionary")
                payload, offsets = row["payload"], row["offsets"]
                ids = [deserialize(unpress.decompress(payload[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                counts = np.array([len(x) for x in ids], np.int64)
                start = bases[row["part"]] + row["first_token"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(counts), pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return shards.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of a few documents: only shards whose index holds one of them are read."""
    wanted = F.array(*[F.lit(int(i)) for i in doc_ids]) if doc_ids else F.array().cast("array<long>")
    hit = spark.read.schema(_SHARDS).parquet(f"{path}/shards").where(F.arrays_overlap("doc_ids", wanted))
    kept = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    asked = set(doc_ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(kept) if kept else None)
        for batch in batches:
            for row in batch.to_pylist():
                at = [k for k, i in enumerate(row["doc_ids"]) if i in asked]
                ids = [deserialize(unpress.decompress(row["payload"][row["offsets"][k] : row["offsets"][k + 1]])) for k in at]
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][k] for k in at], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], ["doc_id", "ids"])

    return hit.mapInArrow(decode, "doc_id long, ids binary")


def token_file_digest(docs: DataFrame, tokenizer: str, *, end_id: int = 1) -> DataFrame:
    """Write the file set under the shared folder, read it back, and give ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    files = write_token_files(docs, new_path(spark, "token-files"), tokenizer, end_id=end_id)
    return read_token_files(spark, files.path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
