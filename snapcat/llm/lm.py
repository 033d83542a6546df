"""Language-model scores by prediction with partial matching (PPM) over bytes.

The model is a trie of byte contexts of up to ORDER bytes with counts from all training texts.  A
symbol (a byte, or the end of the text) is coded in the longest known context; if it did not
occur there, an escape is coded (estimated by the number of distinct symbols of the context) and the
next shorter context is asked, with all symbols of the longer one excluded; below the empty
context all symbols left are equally likely.  The score is the log10 probability of the whole text.

The whole trie is a table.  Since the symbols of a context are among those of its shorter one, exclusion
needs two sums per context (``distinct`` and ``covered``), which are taken over the whole table.  Nodes and
contexts of at least the count at which MAX_NODES nodes suffice are at hand in the tasks, with these sums; a
symbol whose path may touch another one is joined with the rest of the table, each distinct code once.

Beside it stands a unigram score of words (``base_score``), whose counts cover every word: those of the
FREQUENT most frequent words are at hand in the tasks, all others are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcat.llm.common import Hasher, bucket_of, chunks, load, lower_bytes, ranges, small_batches, stage

ORDER = 4
MAX_NODES = 1 << 20
FREQUENT = 1 << 20
#: Orders whose nodes and contexts are always at hand: the alphabet bounds them.
LOW = 1
#: Symbols: bytes, the end of a text, and what stands before a text.
END, BEFORE, SYMBOLS, BITS = 256, 257, 257, 9
#: Name of the end token among word hashes.
END_WORD = 0
#: Slots of the table of whole contexts in a task (a power of two).
SLOTS = 1 << 21
FOLD = 16


def codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Context and symbol, BITS each, at every byte and every end; texts one after another."""
    n, pad = len(offsets) - 1, ORDER + 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    line = np.full(len(data) + pad * n, BEFORE, np.uint64)
    line[np.arange(len(data)) + pad * text + ORDER] = data
    line[offsets[1:] + pad * np.arange(n) + ORDER] = END
    out = line[ORDER:].copy()
    for j in range(1, ORDER + 1):
        out |= line[ORDER - j : len(line) - j] << np.uint64(BITS * j)
    return out[line[ORDER:] != BEFORE]


def word_counts(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, lower: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every word (runs without the six white-space characters)."""
    starts, ends = ranges(word[data], offsets)
    hashes = hasher(lower[data], starts, ends)
    hashes[hashes == END_WORD] = 1
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def word_member() -> np.ndarray:
    out = np.ones(256, bool)
    out[[32, 9, 10, 11, 12, 13]] = False
    return out


def gather(training: DataFrame) -> DataFrame:
    """(kind, key, n): kind 0 counts words, kind 1 contexts with their symbol; summed in each task first."""
    small_batches(training.sparkSession)

    def run(batches):
        hasher, lower, member = Hasher(), lower_bytes(), word_member()
        held: dict[int, list] = {0: [], 1: []}

        def fold(parts):
            keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, where, np.concatenate([p[1] for p in parts]))
            return [(keys, n)]

        def emit(kind):
            if held[kind]:
                (keys, n), = fold(held[kind])
                held[kind] = []
                for lo in range(0, len(keys), 50_000):
                    k = keys[lo : lo + 50_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[lo : lo + 50_000])], ["kind", "key", "n"])

        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(0)):
                words, _ = word_counts(data, offsets, hasher, lower, member)
                keys, n = np.unique(words, return_counts=True)
                held[0].append((np.append(keys, np.uint64(END_WORD)), np.append(n, hi - lo)))
                held[1].append(np.unique(codes(data, offsets), return_counts=True))
                for kind in (0, 1):
                    if len(held[kind]) > FOLD:
                        held[kind] = fold(held[kind])
                        if len(held[kind][0][0]) > 1 << 21:  # a task's memory: hand over what is summed so far
                            yield from emit(kind)
        for kind in (0, 1):
            yield from emit(kind)

    return training.select("text").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def least_count(counts: DataFrame, most: int) -> float:
    """A count that at most ``most`` rows reach, from their distribution over quarter powers of two."""
    step = F.floor(F.log2("n") * 4).alias("step")
    rows = sorted(counts.groupBy(step).agg(F.count(F.lit(1)).alias("m")).collect(), key=lambda r: -r.step)  # at most 256
    total, least = 0, 1.0
    for row in rows:
        total += row.m
        if total > most:
            return 2 ** ((row.step + 1) / 4)
        least = 2 ** (row.step / 4)
    return min(least, 1.0)


class Trie:
    """Per order: sorted codes at hand with their counts, and sorted contexts with total, distinct and covered.

    ``whole``: no node or context is missing.
    """

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]], contexts: list[tuple[np.ndarray, np.ndarray]], whole: bool) -> None:
        self.keys = [k for k, _ in nodes]
        self.n = [n.astype(np.float64) for _, n in nodes]
        self.contexts = [k for k, _ in contexts]
        self.sums = [v.astype(np.float64) for _, v in contexts]
        self.whole = whole
        longest = self.keys[ORDER]
        at, _ = self.find(self.contexts[ORDER], longest >> np.uint64(BITS))  # a node's context occurred as often at least
        value = np.log10(self.n[ORDER] / (self.sums[ORDER][0][at] + self.sums[ORDER][1][at])) if len(longest) else np.zeros(0)
        self.slot_key = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        self.slot_value = np.zeros(SLOTS)
        slots = self.slot(longest)
        self.slot_key[slots] = longest
        self.slot_value[slots] = value  # of two in one slot the last wins in both assignments

    @staticmethod
    def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return at, table[at] == keys

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def look(self, keys: np.ndarray) -> np.ndarray:
        """[order, (total, distinct, covered, n), code] of what is at hand, 0 for what is not."""
        out = np.zeros((ORDER + 1, 4, len(keys)))
        for order in range(ORDER + 1):
            key = part(keys, order)
            at, there = self.find(self.contexts[order], key >> np.uint64(BITS))
            out[order, :3, there] = self.sums[order][:, at[there]].T
            at, there = self.find(self.keys[order], key)
            out[order, 3, there] = self.n[order][at[there]]
        return out

    def missing(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[order, code]: whether the code's node and its context have to be looked for in the table."""
        open_ = np.full(values.shape[2], not self.whole)
        nodes, contexts = np.zeros((2, ORDER + 1, values.shape[2]), bool)
        for order in range(ORDER, LOW, -1):
            contexts[order] = open_ & (values[order, 1] == 0)
            open_ = open_ & (values[order, 3] == 0)
            nodes[order] = open_
        return nodes, contexts

    def probabilities(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each symbol in its context, and which ones the table has to tell (0 for these)."""
        slot = self.slot(keys)
        out, unsure = self.slot_value[slot], np.zeros(len(keys), bool)
        rest = np.flatnonzero(self.slot_key[slot] != keys)
        if len(rest):
            unique, where = np.unique(keys[rest], return_inverse=True)
            values = self.look(unique)
            ask = np.any(self.missing(values), axis=(0, 1))
            out[rest] = np.where(ask, 0.0, walk(values))[where]
            unsure[rest] = ask[where]
        return out, unsure


def part(keys: np.ndarray, order: int) -> np.ndarray:
    """Codes of a shorter context with the same symbol."""
    return keys & np.uint64((1 << (BITS * (order + 1))) - 1)


def walk(values: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol from (total, distinct, covered, n) at each order."""
    size = values.shape[2]
    out, open_ = np.zeros(size), np.ones(size, bool)
    covered, known = np.zeros(size), np.zeros(size)
    for order in range(ORDER, -1, -1):
        all_, symbols, below, n = values[order]
        distinct = symbols - known
        total = all_ - covered + distinct
        ask = open_ & (distinct > 0)
        found = ask & (n > 0)
        out[found] += np.log10(n[found] / total[found])
        missed = ask & ~found
        out[missed] += np.log10(distinct[missed] / total[missed])
        open_ &= ~found
        covered, known = below, symbols
    out[open_] -= np.log10(SYMBOLS - known[open_])
    return out


def train_trie(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables of all nodes (order, key, n) and all contexts (order, key, total, distinct, covered), from (key, n) of the longest contexts."""
    by_order = F.explode(F.array(*(
        F.struct(F.lit(o).alias("order"), F.col("key").bitwiseAND(F.lit((1 << (BITS * (o + 1))) - 1)).alias("key")) for o in range(ORDER + 1))))
    nodes = counts.select(by_order.alias("node"), "n").groupBy("node.order", "node.key").agg(F.sum("n").alias("n"))
    nodes = stage(nodes, "lm-nodes")
    # What the symbols of a context count in the next shorter one: at most SYMBOLS + 1 nodes have the same shorter one.
    shorter = nodes.select((F.col("order") + 1).alias("order"), F.col("key").alias("short"), F.col("n").alias("below"))
    longer = nodes.withColumn("short", F.expr(f"key & (shiftleft(1L, {BITS} * order) - 1)"))
    contexts = longer.join(shorter, ["order", "short"], "left").groupBy("order", F.shiftright("key", BITS).alias("key")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum(F.coalesce("below", F.lit(0))).alias("covered"))
    return nodes, stage(contexts, "lm-contexts")


def at_hand(table: DataFrame, values: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted keys, values) per order, on the driver."""
    rows = table.select("order", "key", *values).toArrow()
    order, key, *columns = (np.asarray(rows[c]) for c in ("order", "key", *values))
    out = []
    for o in range(ORDER + 1):
        mine = np.flatnonzero(order == o)
        mine = mine[np.argsort(key[mine])]
        kept = np.array([c[mine] for c in columns], np.int64)
        out.append((key[mine].astype(np.uint64), kept if len(values) > 1 else kept[0]))
    return out


def settle(codes_: DataFrame, rest: DataFrame, trie_of) -> DataFrame:
    """(code, log): log10 probability of distinct codes by a join with what is not at hand.

    ``rest``: (slot, key, total, distinct, covered, n); slot 2 * order for nodes, 2 * order + 1 for contexts.
    """

    def ask(batches):
        trie = trie_of()
        for b in batches:
            keys = np.asarray(b.column(0)).view(np.uint64)
            missing = trie.missing(trie.look(keys))
            for order in range(LOW + 1, ORDER + 1):
                for kind in (0, 1):
                    mine = keys[missing[kind][order]]
                    wanted = part(mine, order) >> np.uint64(BITS * kind)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mine.view(np.int64)), pa.array(np.full(len(mine), 2 * order + kind, np.int32)), pa.array(wanted.view(np.int64))], ["code", "slot", "key"])

    def tell(batches):
        trie = trie_of()
        for b in batches:
            keys, found = np.asarray(b.column(0)).view(np.uint64), b.column(1)
            values = trie.look(keys)
            of = np.repeat(np.arange(len(keys)), np.asarray(found.value_lengths()))
            rows = found.flatten()
            slot = np.asarray(rows.field(0))
            for kind, names in ((0, [4]), (1, [1, 2, 3])):
                mine = slot % 2 == kind
                for name in names:
                    values[slot[mine] // 2, 3 if kind == 0 else name - 1, of[mine]] = np.asarray(rows.field(name))[mine]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(walk(values))], ["code", "log"])

    asked = codes_.mapInArrow(ask, "code long, slot int, key long")
    row = F.when(F.col("n").isNotNull(), F.struct("slot", "total", "distinct", "covered", "n"))
    found = asked.join(rest, ["slot", "key"], "left").groupBy("code").agg(F.collect_list(row).alias("found"))  # at most two for each order
    return found.mapInArrow(tell, "code long, log double")


def lm_scores(documents: DataFrame, training: DataFrame, extra: list[str]) -> DataFrame:
    """``extra`` columns, n_tokens, n_known, train_tokens, base_score and score of every document row.

    A NULL text counts as empty: one end token.  Repeated rows are scored (and, in training, counted) each.  Without
    training texts every symbol is equally likely and base counts are 0.
    """
    spark = small_batches(documents.sparkSession)
    counts = stage(gather(training), "lm-counts")
    vocabulary = counts.filter("kind = 0").select("key", "n")
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, denominator = int(size.n), float(np.log10(size.n + 0.5 * (size.v + 1)))
    nodes, contexts = train_trie(counts.filter("kind = 1"))
    least = least_count(nodes, MAX_NODES)
    # Contexts occurred as often as their last symbol in the next shorter context, so as many reach ``least`` as nodes do.
    of_nodes, of_contexts = (F.col("order") <= LOW) | (F.col("n") >= least), (F.col("order") <= LOW) | (F.col("total") >= least)
    model = at_hand(nodes.filter(of_nodes), ["n"]), at_hand(contexts.filter(of_contexts), ["total", "distinct", "covered"]), least <= 1
    enough = least_count(vocabulary, FREQUENT)
    frequent = vocabulary.filter(F.col("n") >= enough).toArrow()
    keys, n = np.asarray(frequent["key"]).view(np.uint64), np.asarray(frequent["n"])
    rank = np.argsort(keys)
    shared = spark.sparkContext.broadcast((model, keys[rank], n[rank]))  # about MAX_NODES (twice) and FREQUENT entries at most
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in extra)
    width = len(extra)

    def trie_of():
        return Trie(*shared.value[0])

    def times_in_text(keys, owner):
        """Each key of a text once, with its text and its number."""
        order = np.lexsort((keys, owner))
        keys, owner = keys[order], owner[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(first)
        return keys[begin].view(np.int64), owner[begin], np.diff(np.append(begin, len(keys)))

    def run(batches):
        _, keys, n = shared.value
        trie, hasher, lower, member = trie_of(), Hasher(), lower_bytes(), word_member()
        value = np.log10(n + 0.5) - denominator
        names = [*extra, "row", "n_tokens", "known", "base", "score", "word", "code", "times"]
        for b in batches:
            for lo, hi, data, offsets in chunks(b.column(width + 1)):
                texts = hi - lo
                symbols, begin = codes(data, offsets), offsets[:-1] + np.arange(texts)
                value_of, unsure = trie.probabilities(symbols)
                score = np.add.reduceat(value_of, begin)
                words, owner = word_counts(data, offsets, hasher, lower, member)
                words, owner = np.append(words, np.zeros(texts, np.uint64)), np.append(owner, np.arange(texts))
                at, common = Trie.find(keys, words)
                base = np.bincount(owner[common], weights=value[at[common]], minlength=texts).astype(np.float64)  # integers if empty
                known = np.bincount(owner[common], minlength=texts)
                tokens = np.bincount(owner, minlength=texts)
                none = pa.nulls(texts, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, texts) for c in b.columns[: width + 1]), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score), none, none, none], names)
                at = np.flatnonzero(unsure)
                for k, (key, owner) in enumerate(((words[~common], owner[~common]), (symbols[at], np.searchsorted(begin, at, "right") - 1))):
                    key, owner, times = times_in_text(key, owner)
                    for i in range(0, len(key), 50_000):
                        o = owner[i : i + 50_000]
                        none = pa.nulls(len(o), pa.int64())
                        pair = [pa.array(key[i : i + 50_000]), none]
                        yield pa.RecordBatch.from_arrays(
                            [*(pa.nulls(len(o), c.type) for c in b.columns[:width]), b.column(width).take(pa.array(lo + o)),
                             none, none, *[pa.nulls(len(o), pa.float64())] * 2, *(pair[::-1] if k else pair), pa.array(times[i : i + 50_000])], names)

    rows = documents.select(*extra, F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        run, f"{schema}, row long, n_tokens long, known long, base double, score double, word long, code long, times long")
    rows = stage(rows, "lm-rows")  # rows, their rare words and codes are written together: the numbers agree
    rare = rows.filter("word is not null").select("row", "word", "times")
    counted = rare.join(vocabulary.filter(F.col("n") < enough), F.col("word") == F.col("key"), "left").groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - denominator)).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"))
    sums = ["total", "distinct", "covered"]
    rest = nodes.filter(~of_nodes).select((2 * F.col("order")).alias("slot"), "key", *(F.lit(0).cast("long").alias(c) for c in sums), "n").unionByName(
        contexts.filter(~of_contexts).select((2 * F.col("order") + 1).alias("slot"), "key", *sums, F.lit(0).cast("long").alias("n")))
    asked = rows.filter("code is not null").select("row", "code", "times")
    coded = asked.join(settle(asked.select("code").distinct(), rest, trie_of), "code").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("coded"))
    zero = F.lit(0)
    return rows.filter("word is null and code is null").join(counted, "row", "left").join(coded, "row", "left").select(
        *extra, "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("coded", zero)).alias("score"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    held = F.coalesce(bucket_of("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return lm_scores(documents.select("doc_id", held, "text"), documents.filter(bucket_of("doc_id", 5) != 1), ["doc_id", "held_out"])
