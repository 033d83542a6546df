from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import SF, no_documents, odd_documents
from tokenizers import Tokenizer

from snapcat.llm import packing, token_files
from snapcat.llm.common import chunks, load
from snapcat.llm.tokens import Encoder

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,spaced", [(BYTES, True), (WORDS, False)])
def test_pieces_give_the_ids_of_the_library(path, spaced):
    random.seed(3)
    parts = ["'s", "'", "'ll", "'t", "'re", "'d", "'ve", " ", "  ", "\n", "\t", "a", "b", "B", "9", "12", ".", "!!", "é", "Ü", "ß", "\r\n", "x"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    for content in ("<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>"):
        texts += [content, f"a {content} b", f"{content}{content}x", f"it's{content}'s", content[:-1], content[1:], "plain after it"]
    texts += ["東京 a", "x×y", "a\xa0b", "İa", "<|endoftext|> a", "é", "ΑΣ Σ", "\x00", ""]
    encoder, found = Encoder(path, spaced), []
    for lo, hi, data, offsets in chunks(pa.array(texts), 1 << 12):
        ids, ends = encoder(data, offsets)
        found += [ids[s:e].tolist() for s, e in zip([0, *ends[:-1]], ends)]
    encode = library(path)
    assert [t for t, ids in zip(texts, found) if ids != encode(t)] == []


def packed_right(documents, rows, capacity=1024):
    encode, by = library(BYTES), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for doc_id, texts in documents.items():
        want = []
        for text in texts:
            ids = np.array([*encode(text), 2], "<u4")
            first = len(ids) % capacity or min(len(ids), capacity)
            bounds = [0, *range(first, len(ids) + 1, capacity)]
            want += [(i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(bounds, bounds[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[doc_id]) == sorted(want)
    assert set(by) == set(documents)
    places = collections.defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in rows)


def texts_of(df):
    out = collections.defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        out[r.doc_id].append(r.text)
    return out


def test_packing(spark):
    documents = load(spark, SF, "documents")
    sequences, tokens = packed_right(texts_of(documents), packing.op1_best_fit_packing(spark, SF).collect())
    assert sequences <= 1.01 * tokens / 1024 + 2


def test_packing_odd_rows(spark):
    documents = odd_documents(spark)
    rows = packing.pack(documents, BYTES, keep_ids=True).collect()
    packed_right(texts_of(documents), rows)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(no_documents(spark), BYTES).collect() == []


def test_sweep_takes_the_smallest_gap_that_suffices():
    placed = packing.sweep({70: 1, 60: 1, 30: 2, 40: 1}, 100)
    at = {(length, rank): (first + rank - lo, offset) for length, lo, hi, first, offset in placed for rank in range(lo, hi)}
    assert at[40, 0] == (at[60, 0][0], 60)  # 40 fits the gap of 40 exactly
    assert at[30, 0] == (at[70, 0][0], 70) and at[30, 1][0] not in (at[70, 0][0], at[60, 0][0])


def best_fit_decreasing(sizes, capacity):
    """Number of sequences when each piece, longest first, goes to the fullest sequence that takes it."""
    gaps = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        if fits:
            best = min(fits)
            gaps.remove(best)
            gaps.append(best - size)
        else:
            gaps.append(capacity - size)
    return len(gaps)


def test_sweep_packs_as_best_fit_of_single_rows():
    draw = random.Random(6)
    for trial in range(60):
        capacity = draw.choice([10, 64, 1024])
        sizes = [min(capacity, 1 + int(draw.expovariate(4 / capacity))) for _ in range(draw.randint(1, 400))]
        used, at = {}, set()
        for length, lo, hi, first, offset in packing.sweep(dict(collections.Counter(sizes)), capacity):
            for rank in range(lo, hi):
                assert (length, rank) not in at
                at.add((length, rank))
                used.setdefault(first + rank - lo, []).append((offset, length))
        assert len(at) == len(sizes)
        for found in used.values():
            end = 0
            for offset, length in sorted(found):
                assert offset == end
                end += length
            assert end <= capacity
        assert len(used) <= best_fit_decreasing(sizes, capacity)


def test_sweep_state_does_not_grow_with_the_corpus():
    """A hundred thousand million pieces of all lengths: the same runs as for few."""
    draw = random.Random(8)
    counts = {length: draw.randint(1, 2 * 10**8) for length in range(1, 1025)}
    placed = packing.sweep(counts, 1024)
    assert len(placed) < 200_000
    assert sum(hi - lo for _, lo, hi, _, _ in placed) == sum(counts.values())


def test_ranks_of_a_frequent_length_are_complete(spark):
    documents = spark.range(9000).selectExpr("id AS doc_id", "'same text' AS text")
    rows = packing.pack(documents, BYTES).collect()
    assert len(rows) == 9000 and len({(r.sequence_id, r.offset) for r in rows}) == 9000
    assert len({r.sequence_id for r in rows}) == -(-9000 // (1024 // rows[0].length))


def check_files(documents, rows):
    encode, start = library(WORDS), 0
    order = sorted(documents, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    found = sorted(rows, key=lambda r: r.start)
    assert len(order) == len(found)
    for want, got in zip(order, found):
        ids = np.array([*encode(want.text), 2], "<u4")
        assert (got.doc_id, got.start, got.n_tokens, got.ids_crc32) == (want.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_round_trip(spark):
    check_files(load(spark, SF, "documents").select("doc_id", "text").collect(), token_files.op4_token_files(spark, SF).collect())


def test_token_files_odd_rows(spark, tmp_path):
    documents = odd_documents(spark)
    manifest, dictionary = token_files.write_ids(documents, str(tmp_path / "f"), WORDS)
    check_files(documents.select("doc_id", "text").collect(), token_files.read_ids(manifest, str(tmp_path / "f"), dictionary).collect())
    encode = library(WORDS)
    held = {d: f for f in (r.file for r in manifest.collect()) for d in [4, 8]}
    for doc_id, text in ((4, odd_documents(spark).filter("doc_id = 4").first().text), (8, odd_documents(spark).filter("doc_id = 8").first().text)):
        found = []
        for file in {r.file for r in manifest.collect()}:
            try:
                found.append(token_files.read_document(str(tmp_path / "f"), file, dictionary, doc_id).tolist())
            except KeyError:
                pass
        assert held and found == [[*encode(text), 2]]
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_ids(manifest, str(tmp_path / "f"), dictionary + b"x").collect()
    manifest, dictionary = token_files.write_ids(no_documents(spark), str(tmp_path / "none"), WORDS)
    assert token_files.read_ids(manifest, str(tmp_path / "none"), dictionary).collect() == []
