"""Token ids in binary files: one zstandard frame per document under a shared dictionary.

File: MAGIC, SHA-256 of the dictionary, bytes per id; the frames one after another; then per
document doc_id, whether it is NULL, byte offset of its frame, number of ids; at the end the offset of that index and the
number of documents.  Documents lie in ascending doc_id order over all files.  A short document is
read by its index entry and one small read; the dictionary makes short frames small.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapcat.llm.common import hashed_sample, chunks, load, small_batches, stage
from snapcat.llm.tokens import Encoder, with_end
from snapcat.session import scratch_path

MAGIC = b"IDS1"
END_ID = 2
#: Dictionary: trained on at most so many documents, chosen by the hash of their id, so many bytes of each.
SAMPLE_DOCUMENTS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 1 << 14, 1 << 16
LEVEL = 3
INDEX = np.dtype([("doc_id", "<i8"), ("no_id", "<i8"), ("offset", "<i8"), ("n", "<i8")])
TAIL = np.dtype([("index", "<i8"), ("documents", "<i8")])


def id_width(tokenizer: str) -> int:
    """Bytes per id: two while the vocabulary allows."""
    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


def train_dictionary(documents: DataFrame, tokenizer: str, spaced: bool, width: int) -> bytes:
    """Dictionary of a bounded sample (SAMPLE_DOCUMENTS times SAMPLE_BYTES at most reach the driver)."""

    def run(batches):
        encoder = Encoder(tokenizer, spaced)
        for b in batches:
            out = []
            for lo, hi, data, offsets in chunks(b.column(0)):
                ids, ends = encoder(data, offsets)
                bounds = np.concatenate([[0], ends])
                out += [ids[s:e].astype(f"<u{width}").tobytes()[:SAMPLE_BYTES] for s, e in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), b.column(1)], ["ids", "h"])

    texts = documents.filter("text is not null").select("text", F.xxhash64("doc_id", "text").alias("h"))
    # Encoded and cut where the texts are; repeated rows count once.
    sample = hashed_sample(texts, SAMPLE_DOCUMENTS).mapInArrow(run, "ids binary, h long").groupBy("h").agg(F.first("ids").alias("ids"))
    found = [bytes(r.ids) for r in sample.orderBy("h").collect() if r.ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few documents to learn from
        return b"".join(found)[:DICTIONARY_BYTES]


def write_ids(documents: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, spaced: bool = False) -> tuple[DataFrame, bytes]:
    """Write all documents; (manifest with a row per file: part, file, documents, ids), dictionary).

    Files have names of their own for every attempt of a task, and the manifest lists those of the attempts
    that counted.  NULL texts are empty; NULL ids come first; repeated rows are written each.
    """
    small_batches(documents.sparkSession)
    width = id_width(tokenizer)
    dictionary = train_dictionary(documents, tokenizer, spaced, width)
    digest = hashlib.sha256(dictionary).digest()
    magic, level, index_type, tail_type = MAGIC, LEVEL, INDEX, TAIL

    def run(batches):
        encoder = Encoder(tokenizer, spaced)
        compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        target, path = fs.FileSystem.from_uri(folder)
        out, name, at, total, index = None, "", 0, 0, []
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                target.create_dir(path, recursive=True)
                name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
                out = target.open_output_stream(f"{path}/{name}")
                out.write(magic + digest + bytes([width]))
                at = len(magic) + len(digest) + 1
            for lo, hi, data, offsets in chunks(b.column(1)):
                ids, bounds = with_end(*encoder(data, offsets), end_id)
                raw = ids.astype(f"<u{width}")
                for i, doc in enumerate(b.column(0).slice(lo, hi - lo).to_pylist()):
                    frame = compressor.compress(raw[bounds[i] : bounds[i + 1]].tobytes())
                    index.append((-(1 << 63) if doc is None else doc, doc is None, at, bounds[i + 1] - bounds[i]))
                    out.write(frame)
                    at += len(frame)
                total += len(ids)
        if out is not None:
            out.write(np.array(index, index_type).tobytes())
            out.write(np.array([(at, len(index))], tail_type).tobytes())
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([name]), pa.array([len(index)], pa.int64()), pa.array([total], pa.int64())],
                ["part", "file", "documents", "ids"])

    # Cut by range before encoding, so that the texts are encoded once.
    laid = documents.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(laid.mapInArrow(run, "part long, file string, documents long, ids long"), "ids-manifest"), dictionary


def open_index(stream, digest: bytes) -> tuple[np.ndarray, int]:
    """Index and bytes per id of a file; the dictionary must be the one it was written with."""
    size = stream.size()
    stream.seek(0)
    head = stream.read(len(MAGIC) + 33)
    if head[: len(MAGIC)] != MAGIC or head[len(MAGIC) : -1] != digest:
        raise ValueError("no file of this format, or written with another dictionary")
    stream.seek(size - TAIL.itemsize)
    tail = np.frombuffer(stream.read(TAIL.itemsize), TAIL)[0]
    stream.seek(int(tail["index"]))
    return np.frombuffer(stream.read(int(tail["documents"]) * INDEX.itemsize), INDEX), head[-1]


def read_document(folder: str, file: str, dictionary: bytes, doc_id: int) -> np.ndarray:
    """Ids of one document (KeyError if the file has none of that id): its index entry and one read of its frame."""
    target, path = fs.FileSystem.from_uri(folder)
    with target.open_input_file(f"{path}/{file}") as stream:
        index, width = open_index(stream, hashlib.sha256(dictionary).digest())
        at = int(np.searchsorted(index["doc_id"], doc_id))  # NULL ids come first, as the smallest number
        while at < len(index) and index["doc_id"][at] == doc_id and index["no_id"][at]:
            at += 1
        if at == len(index) or index["doc_id"][at] != doc_id:
            raise KeyError(doc_id)
        stream.seek(int(index["offset"][at]))
        end = int(index["offset"][at + 1]) if at + 1 < len(index) else stream.size()
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompressobj()
        return np.frombuffer(plain.decompress(stream.read(end - int(index["offset"][at]))), f"<u{width}").astype(np.uint32)


def read_ids(manifest: DataFrame, folder: str, dictionary: bytes, keep_ids: bool = False) -> DataFrame:
    """Documents of all files: doc_id, start (ids before it), n_tokens, ids_crc32, [ids as 32-bit integers]."""
    digest = hashlib.sha256(dictionary).digest()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "file", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")).alias("base"))
    n = max(1, manifest.count())

    def run(batches):
        target, path = fs.FileSystem.from_uri(folder)
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
        types = [pa.int64()] * 4 + [pa.binary()] * keep_ids
        for b in batches:
            for file, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with target.open_input_file(f"{path}/{file}") as stream:
                    index, width = open_index(stream, digest)
                    starts = base + np.cumsum(index["n"]) - index["n"]
                    ends = np.append(index["offset"][1:], stream.size() - TAIL.itemsize - len(index) * INDEX.itemsize)
                    for lo in range(0, len(index), 500):
                        part = index[lo : lo + 500]
                        stream.seek(int(part["offset"][0]))
                        raw = memoryview(stream.read(int(ends[lo : lo + 500][-1] - part["offset"][0])))
                        ids = []
                        for s, e, count in zip((part["offset"] - part["offset"][0]).tolist(), (ends[lo : lo + 500] - part["offset"][0]).tolist(), part["n"].tolist()):
                            ids.append(np.frombuffer(plain.decompress(raw[s:e], max_output_size=count * width), f"<u{width}").astype("<u4").tobytes())
                        columns = [[None if no else d for d, no in zip(part["doc_id"].tolist(), part["no_id"].tolist())],
                                   starts[lo : lo + 500], [len(x) // 4 for x in ids], [zlib.crc32(x) for x in ids]] + [ids] * keep_ids
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return files.repartitionByRange(n, "part").select("file", "base").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest, dictionary = write_ids(load(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(manifest, folder, dictionary)
