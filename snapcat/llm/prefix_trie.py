"""Prefix trie of conversations, summed upwards by depth bands.

A node is a distinct sequence of first turns, named by 128 bits that are XOR-ed from a hash per place, role and text.
Subtree sums: nodes explode only to their ancestors within a band of BAND depths; the band roots, with the
sums of their bands, form a trie of a BAND-th of the depth, which is summed by the same rule; then each band root's
completed total is added to its ancestors in the band above.  A node explodes to at most 2 * BAND rows and the
number of rounds is logarithmic in the depth.

Ancestors need no pointers: the smallest member of a node has all of them among its own prefixes.
"""

from __future__ import annotations

import hashlib
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapcat.llm.common import batch, load, stage

BAND = 16
#: Conversations of a head: id - id % FAMILY gives the first hash % VARIANTS turns.
FAMILY, VARIANTS = 20, 4
#: Consecutive places (or turn numbers, ids) handled as one sorted group, as bits.
BLOCK_BITS = 10
IDS_BITS = 8
WORD = r"[^\x20\x09-\x0D]+"


def running(df: DataFrame, group: str, block: Column, order: list[Column], sums: dict[str, Column], values: dict[str, Column]) -> DataFrame:
    """Add running aggregates over ``order`` within ``group``, block by block.

    ``block`` must not decrease along ``order``; a group of any size is thus never sorted in one task.
    ``sums`` give running aggregates of a row's column (counts, XOR), ``values`` combine a running value and what
    earlier blocks brought, both columns called by the name.
    """
    df = df.withColumn("block", block)
    inside = Window.partitionBy(group, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({name: c.over(inside) for name, c in sums.items()})
    totals = df.groupBy(group, "block").agg(*(c.alias(f"{name}_all") for name, c in sums.items()))
    carried = totals.select(group, "block", *(combine_over(name, sums, earlier).alias(f"{name}_before") for name in sums))
    return local.join(carried, [group, "block"]).withColumns(values).drop("block", *(f"{n}_before" for n in sums))


def combine_over(name: str, sums: dict[str, Column], window) -> Column:
    total = F.col(f"{name}_all")
    return (F.sum(total) if name == "n" else F.bit_xor(total)).over(window)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, rn from 0, two hashes of role and text, words of the text): the text itself is never shuffled."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit("second"), text, F.lit("of"), role).alias("h2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    # Two places earlier than any number is NULL; ties are broken by the hashes.
    block = F.coalesce(F.shiftright("turn", BLOCK_BITS), F.lit(-(1 << 62)))
    one = F.count(F.lit(1))
    return running(slim, "conv_id", block, [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("words")], {"n": one},
                   {"rn": F.col("n") + F.coalesce("n_before", F.lit(0)) - 1}).drop("n", "turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their new place ``d`` (from 1), and a row per conversation with its new length."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    convs = sizes.select(
        "conv_id", "size", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % VARIANTS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = sizes.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_size", F.lit(0).cast("long"))))
    convs = stage(convs.withColumn("length", F.col("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0).cast("long"))), "trie-convs")
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("rn") < VARIANTS - 1)).withColumnRenamed("conv_id", "base")
    taken = convs.filter("head > 0").select("conv_id", "base", "head").join(heads, "base").filter("rn < head").select(
        "conv_id", (F.col("rn") + 1).alias("d"), "h1", "h2", "words")
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").filter("rn >= h").select(
        "conv_id", (F.col("head") + F.col("rn") - F.col("h") + 1).alias("d"), "h1", "h2", "words")
    return taken.unionByName(own), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, d, p, q, pp, pq, words, ends): every prefix's name, its parent's name, the root included."""
    own = {"p": F.xxhash64("d", "h1", "h2"), "q": F.xxhash64("h2", "d", "h1")}
    placed = turns.withColumns({"own_p": own["p"], "own_q": own["q"]}).drop("h1", "h2")
    named = running(
        placed, "conv_id", F.shiftright("d", BLOCK_BITS), [F.col("d")], {c: F.bit_xor(F.col(f"own_{c}")) for c in own},
        {c: F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0).cast("long"))) for c in own})
    named = named.withColumns({f"p{c}": F.col(c).bitwiseXOR(F.col(f"own_{c}")) for c in own})
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    below = named.join(convs, "conv_id").select("conv_id", "d", "p", "q", "pp", "pq", "words", (F.col("d") == F.col("length")).alias("ends"))
    roots = convs.select(
        "conv_id", zero.alias("d"), zero.alias("p"), zero.alias("q"), none.alias("pp"), none.alias("pq"), zero.alias("words"), (F.col("length") == 0).alias("ends"))
    return roots.unionByName(below)


NODE = ["d", "p", "q"]


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """Sums of ``values`` over every node's subtree.

    ``nodes``: d, p, q, rep (a member) and values; ``paths``: rep, d, p, q, all prefixes of the members.
    """
    paths = paths.withColumn("band", F.shiftright("d", band.bit_length() - 1))
    nodes = nodes.withColumn("band", F.shiftright("d", band.bit_length() - 1))
    up = paths.select("rep", "band", F.col("d").alias("to"), F.col("p").alias("up_p"), F.col("q").alias("up_q"))
    # Within the band: a node's prefixes from the band's root down to itself.
    inside = nodes.drop("p", "q").join(up, ["rep", "band"]).filter(F.col("to") <= F.col("d"))

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy(F.col("to").alias("d"), F.col("up_p").alias("p"), F.col("up_q").alias("q")).agg(*(F.sum(v).alias(v) for v in values))

    within = stage(summed(inside), "trie-band")
    roots = nodes.filter((F.col("d") > 0) & (F.col("d") % band == 0)).select("d", "p", "q", "rep")
    if roots.isEmpty():
        return within
    # The trie of band roots, a band-th as deep.
    level = F.shiftright("d", band.bit_length() - 1).alias("d")
    members = nodes.filter(F.col("d") % band == 0).select("d", "p", "q", "rep").join(within, NODE)
    totals = subtree_sums(
        members.select(level, "p", "q", "rep", *values), paths.filter(F.col("d") % band == 0).select("rep", level, "p", "q"), values, band)
    done = roots.select(level, "p", "q", "rep").join(totals, NODE).withColumn("band", F.col("d") - 1)
    # A completed band root counts for its ancestors in the band above.
    passed = summed(done.drop("d", "p", "q").join(up, ["rep", "band"]))
    return stage(within.unionByName(passed).groupBy(NODE).agg(*(F.sum(v).alias(v) for v in values)), "trie-sums")


def joined_ids(ends: DataFrame) -> DataFrame:
    """(d, p, q, ids_sha256): hash of the ascending ids that end at a node, joined by commas.

    Ids are first joined in blocks of 2**IDS_BITS consecutive ids, so that a node with very many ends is sorted in
    pieces; only the hash itself, which is sequential, reads a node's blocks in order, one at a time.
    """
    blocks = ends.groupBy(*NODE, F.shiftright("conv_id", IDS_BITS).alias("block")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))

    def run(batches):
        schema = pa.schema([("d", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("ids_sha256", pa.string())])
        rows = ((tuple(r[:3]), r[3]) for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for node, parts in itertools.groupby(rows, key=lambda r: r[0]):
            digest = hashlib.sha256()
            for k, (_, ids) in enumerate(parts):
                digest.update((b"," if k else b"") + ids.encode())
            yield node, digest.hexdigest()

    def batched(batches):
        schema = pa.schema([("d", pa.int64()), ("p", pa.int64()), ("q", pa.int64()), ("ids_sha256", pa.string())])
        for some in itertools.batched(run(batches), 10_000):
            yield batch(schema, *zip(*((*node, text) for node, text in some)))

    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "block").select(*NODE, "ids").mapInArrow(
        batched, "d long, p long, q long, ids_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the rebuilt conversations' prefix trie.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    NULL roles and texts are empty; rows without conv_id belong to no conversation; turns under one number (repeated
    rows too) are all kept, ordered by a hash of role and text.  A conversation left without turns is a member of the
    root.  No conversations give no rows; other columns are ignored.
    """
    turns = stage(ordered_turns(conversations), "trie-turns")
    placed, convs = rebuilt(turns)
    paths = stage(prefixes(placed, convs), "trie-paths")
    nodes = stage(
        paths.groupBy(NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep"), F.max("words").alias("words"),
            F.min("pp").alias("pp"), F.min("pq").alias("pq"), F.count_if("ends").alias("n_ends")), "trie-nodes")
    children = nodes.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pp").alias("p"), F.col("pq").alias("q")).agg(
        F.count(F.lit(1)).alias("n_children"))
    zero = F.lit(0).cast("long")
    nodes = stage(nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", zero),
        "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}), "trie-values")
    sums = subtree_sums(
        nodes.select(*NODE, "rep", "n_leaves", "saved_tokens"), paths.select(F.col("conv_id").alias("rep"), *NODE), ["n_leaves", "saved_tokens"])
    parents = nodes.filter("n_children > 0").select((F.col("d") + 1).alias("d"), F.col("p").alias("pp"), F.col("q").alias("pq"), F.col("rep").alias("parent_conv_id"))
    out = nodes.drop("n_leaves", "saved_tokens").join(parents, ["d", "pp", "pq"], "left").join(sums, NODE).join(
        joined_ids(paths.filter("ends").select(*NODE, "conv_id")), NODE, "left")
    return out.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ids_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(load(spark, sf_dir, "conversations"))


OP11_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS rn,
                  coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, count(*) AS size FROM t GROUP BY conv_id),
-- crc32 (reflected polynomial 0xEDB88320) of the decimal id, modulo 4
h AS (SELECT conv_id, size, conv_id - conv_id % 20 AS base, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384)), 4294967295), 4294967295) % 4 AS h FROM s),
c AS (SELECT h.conv_id, h.base, h.h, least(h.h, coalesce(b.size, 0)) AS head FROM h LEFT JOIN s b ON h.base = b.conv_id),
r AS (SELECT c.conv_id, rn + 1 AS d, role, text FROM c JOIN t ON t.conv_id = c.base AND t.rn < c.head
      UNION ALL SELECT c.conv_id, c.head + rn - c.h + 1, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.rn >= c.h),
p AS (SELECT conv_id, d, text, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS k FROM r
      UNION ALL SELECT conv_id, 0, '', '' FROM c),
m AS (SELECT conv_id, max(d) AS len FROM p GROUP BY conv_id),
n AS (SELECT p.d, p.k, count(*) AS n_convs, min(p.conv_id) AS conv_id, max(len(regexp_extract_all(p.text, '[^\x20\x09-\x0D]+'))) AS words,
             sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE p.d = len), '')) AS ends_sha256
      FROM p JOIN m ON p.conv_id = m.conv_id GROUP BY p.d, p.k),
e AS (SELECT n.*, CASE WHEN d > 0 THEN left(k, CAST(length(k) - 128 AS BIGINT)) END AS pk FROM n),
k AS (SELECT pk, count(*) AS n_children FROM e WHERE pk IS NOT NULL GROUP BY pk),
v AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN k ON e.k = k.pk),
u AS (SELECT p.k, sum(CAST(v.n_children = 0 AS BIGINT)) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
      FROM v JOIN p ON p.conv_id = v.conv_id AND p.d <= v.d GROUP BY p.k)
SELECT v.conv_id, v.d AS depth, a.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN u ON v.k = u.k LEFT JOIN v a ON v.pk = a.k
"""
