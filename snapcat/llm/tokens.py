"""Token ids of whole texts, from one tokenizer file, at the speed of array operations.

A byte-level BPE first cuts a text into pieces and then encodes every piece on its own.  Here the
cutting runs over the bytes of a whole batch, pieces are named by a 64-bit hash, and the
tokenizer encodes each distinct piece once per worker.  Texts with characters whose
class depends on more than their byte (all beyond Latin letters) go to the tokenizer as they are.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from snapcat.llm.common import Hasher, mix

#: Pieces a worker remembers; beyond that it starts anew (a cache: results don't depend on it).
REMEMBERED = 1 << 20
SPACE, OTHER_SPACE, LETTER, DIGIT, MARK = range(5)


def byte_classes() -> np.ndarray:
    out = np.full(256, MARK, np.uint8)
    out[32] = SPACE
    out[[9, 10, 13]] = OTHER_SPACE
    out[48:58] = DIGIT
    out[65:91] = out[97:123] = LETTER
    out[128:] = LETTER  # in texts that odd_texts lets pass
    return out


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with more than printable ASCII, tab, line ends and the letters U+00C0 to U+017F."""
    n = len(offsets) - 1
    odd_byte = np.zeros(256, bool)
    odd_byte[:32] = True
    odd_byte[[9, 10, 13]] = False
    odd_byte[127] = True
    odd_byte[192:195] = True  # C0 to C2: U+0080 to U+00BF
    odd_byte[198:] = True  # C6 and up: from U+0180
    odd = odd_byte[data]
    if len(data) > 1:
        lead, trail = data[:-1], data[1:]
        # The signs × and ÷, and the capital I with a dot, whose lower case is two characters.
        odd[:-1] |= ((lead == 0xC3) & ((trail == 0x97) | (trail == 0xB7))) | ((lead == 0xC4) & (trail == 0xB0))
    out = np.zeros(n, bool)
    out[np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1] = True
    return out


def contraction_length(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bytes of 's 't 'm 'd 're 've 'll at each apostrophe, else 0."""
    n = len(data)
    one = np.where(at + 1 < end, data[np.minimum(at + 1, n - 1)], 0)
    two = np.where(at + 2 < end, data[np.minimum(at + 2, n - 1)], 0)
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    return np.where(short, 2, np.where(long, 3, 0))


def cut(data: np.ndarray, offsets: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all texts.

    ``spaced``: one space belongs to the piece after it, runs of digits are one piece, white space gives
    pieces; otherwise digits are single pieces and white space gives none.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = byte_classes()[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    new = np.empty(n, bool)
    new[0], new[1:] = True, kind[1:] != kind[:-1]
    blank = kind <= OTHER_SPACE
    new[1:] &= ~(blank[1:] & blank[:-1])
    new |= edge[:n]
    # Contractions begin where an apostrophe begins a piece (spaced: and no space would be taken into it).
    quotes = np.flatnonzero(data == 39)
    quotes = quotes[new[quotes]]
    if len(quotes):
        if spaced:
            before = np.where(edge[quotes] | (quotes == 0), 0, data[np.maximum(quotes - 1, 0)])
            quotes = quotes[before != 32]
        end = offsets[np.searchsorted(offsets, quotes, "right")]
        length = contraction_length(data, quotes, end)
        quotes, length = quotes[length > 0], length[length > 0]
        for k in (1, 2):
            inner = quotes[length > k] + k
            new[inner] = False
        after = quotes + length
        new[after[after < n]] = True
    if not spaced:
        new |= kind == DIGIT
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        keep = ~blank[starts]
        return starts[keep], ends[keep]
    # The last white-space character before other text: a space joins the next piece, another one stands alone.
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~edge[1:n])
    spaces = last[data[last] == 32]
    new[last] = True
    new[spaces + 1] = False
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], n)


class Encoder:
    """Ids of batches of texts as (flat ids, end of each text)."""

    def __init__(self, path: str, spaced: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core

        # Kept by the worker process: later tasks find the pieces of earlier ones.
        home = sys.modules.setdefault("_piece_memory", types.ModuleType("_piece_memory"))
        kept = home.__dict__.setdefault("kept", {})
        if path not in kept:
            tokenizer = Tokenizer.from_file(path)
            added = sorted({t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values() if t.content})
            kept[path] = {"tokenizer": tokenizer, "hasher": Hasher(), "added": added}
            self.memory = kept[path]
            self.forget()
        self.memory = kept[path]
        self.spaced = spaced

    def forget(self) -> None:
        self.memory |= {"keys": np.zeros(0, np.uint64), "where": np.zeros(0, np.int64), "length": np.zeros(0, np.int64), "ids": np.zeros(0, np.uint32)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.memory["tokenizer"].encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        m = self.memory
        raw = data.tobytes()
        ids = self.encode([raw[s:e].decode() for s, e in zip(starts.tolist(), ends.tolist())])
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        where = len(m["ids"]) + np.cumsum(length) - length
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(length.sum()))
        at = np.searchsorted(m["keys"], keys)  # both are sorted
        m |= {"keys": np.insert(m["keys"], at, keys), "where": np.insert(m["where"], at, where),
              "length": np.insert(m["length"], at, length), "ids": np.concatenate([m["ids"], flat])}

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        odd = odd_texts(data, offsets) | self.holds_added(data, offsets)
        if odd.any():
            return self.mixed(data, offsets, odd)
        if not self.spaced:
            lowered = bytes(data).decode().lower().encode()  # lower case keeps the length of these characters
            data = np.frombuffer(lowered, np.uint8)
        starts, ends = cut(data, offsets, self.spaced)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        keys = mix(self.memory["hasher"](data, starts, ends) + (ends - starts).astype(np.uint64))
        unique, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        m = self.memory
        at = np.minimum(np.searchsorted(m["keys"], unique), max(len(m["keys"]) - 1, 0))
        missing = m["keys"][at] != unique if len(m["keys"]) else np.ones(len(unique), bool)
        if missing.any():
            if len(m["keys"]) > REMEMBERED:
                self.forget()
                missing[:] = True
            self.learn(data, unique[missing], starts[first[missing]], ends[first[missing]])
            at = np.searchsorted(m["keys"], unique)
        length, where = m["length"][at][inverse], m["where"][at][inverse]
        total = np.cumsum(length)
        flat = m["ids"][np.repeat(where - (total - length), length) + np.arange(total[-1])]
        pieces_end = np.searchsorted(starts, offsets[1:], "left")
        return flat, np.concatenate([[0], total])[pieces_end]

    def holds_added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with the string of an added token (in any case of letters): what it becomes is the library's business."""
        out, raw = np.zeros(len(offsets) - 1, bool), data.tobytes().lower()
        for content in self.memory["added"]:
            at = raw.find(content)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                out[text] = True
                at = raw.find(content, max(at + 1, int(offsets[text + 1]) - len(content) + 1))
        return out

    def mixed(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of ordinary texts by pieces, the others by the tokenizer itself."""
        out, sizes = [], []
        for i in range(len(odd)):
            lo, hi = int(offsets[i]), int(offsets[i + 1])
            if odd[i]:  # the whole text, as it is
                out.append(np.asarray(self.encode([bytes(data[lo:hi]).decode()])[0], np.uint32))
            else:
                out.append(self(data[lo:hi], np.array([0, hi - lo]))[0])
            sizes.append(len(out[-1]))
        return np.concatenate(out), np.cumsum(sizes)


def with_end(flat: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text: ids and bounds (one more than texts)."""
    n = len(ends)
    bounds = np.concatenate([[0], ends + np.arange(1, n + 1)])
    out = np.empty(len(flat) + n, np.uint32)
    stop = bounds[1:] - 1
    body = np.ones(len(out), bool)
    body[stop] = False
    out[body] = flat
    out[stop] = end_id
    return out, bounds


def as_binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary column whose row n is the items bounds[n] to bounds[n + 1]."""
    width = data.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * width).astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())
