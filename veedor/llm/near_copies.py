"""SimHash near-duplicates by similarity of word shingle sets: ball hashing of fingerprint blocks, verified exactly.

Sets with a Jaccard similarity t have a cosine of 2t / (1 + t), so each bit of their SimHash differs
with a fixed chance (0.15 for t = 0.8): 64 bits then differ in about 10 places, too many to emit a
ball of half that radius. So a fingerprint has several blocks of bits, and the meeting in the middle
is done block by block: every block emits itself and its variants with one bit flipped, and two
blocks meet at a variant exactly if they differ in two bits at most. A block is eight bits wider than
the number of documents in binary, so that a document meets a bounded number of others by chance
however many there are, and there are as many blocks as give a pair at the similarity a chance of
``recall`` to meet. Pairs that meet are first compared by their bits, inside the join, so that only
close pairs ever become rows: those of the many balls by 128 bits, and what these leave by all bits.
Three standard deviations are allowed (five of the 128 bits), which one similar pair in 800 exceeds.
With the bits goes the parity of the hashes in each of 512 bins: what only one set has turns one
parity, so sets differ in no fewer hashes than parities, and pairs with too many different parities
for the similarity are no links, for certain. Then they are compared by their whole sets.

1. Copies collapse to one set. Documents with an equal block are compared with four of them, the
   smallest by their numbers and by three other orders: large groups become connected here, at a few
   comparisons a member.
2. Documents with an equal block are one class, which emits its ball once, a few blocks at a time: a
   variant then has no more visitors than a ball has members, however large a group is. Only variants
   with visitors of different components are kept. The ends of the classes are compared with the
   smallest and the largest visitor there; then all pairs between what are still different components
   are compared. A pair that connects nothing new is never formed, one that could is never left out.
3. Components of the verified links; of each, the document with the smallest id stays.

Sets are of 64-bit hashes. Texts of fewer words than a shingle are one shingle. Null and empty texts
are copies of each other and similar to nothing else. Ties do not matter: links are between groups
of equal sets, and of equal ids the first row stays. Other columns are kept as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RID, discard, materialize, small_batches, stable_rows, tasks_for
from .components import connected_components

RECALL = 0.95  # of pairs at the similarity itself; more similar ones meet more surely
AT_ONCE = 2  # blocks whose balls are shuffled together
SIGNS = 8  # further 64 bits of a fingerprint, in no block
PARITY = 8  # 64 bins of hashes, of which the parity is kept
CHECK = SIGNS + PARITY + 1  # numbers before the blocks: those, and the set's size
PEEK = 2  # of those, what pairs that meet by chance carry through a shuffle before the rest
ORDERS = (0, (1 << 62) - 1, 0x2545F4914F6CDD1D, 0x1B873593CC9E2D51)  # a number with these bits flipped: four orders of numbers
SPREAD = 8192  # documents whose balls one task emits
_CHUNK = 4096  # shingles whose bits are counted at once


def bit_difference(similarity: float) -> float:
    """The chance that a fingerprint bit of two sets differs."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def layout(n: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Width and number of the blocks for n documents."""
    width = max(16, n.bit_length() + 8)
    p = bit_difference(similarity)
    meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
    return width, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def shingle_set(text: bytes | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.int64)
    line = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *stops[:-shingle].tolist()]
    ends = (stops[shingle - 1 :] - 1).tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[a:b], seed) for a, b in zip(starts, ends, strict=True)], np.uint64).view(np.int64))


def fingerprint_bits(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """For each bit, whether over half of the shingles have it. Bits beyond 64 come from mixing the hash with counters."""
    words = -(-n_bits // 64)
    step = np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ones = np.zeros(64 * words, np.int64)
    for begin in range(0, len(hashes), _CHUNK):
        x = hashes[begin : begin + _CHUNK].view(np.uint64)[:, None] + step
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return (2 * ones > len(hashes))[:n_bits]


def bin_parities(hashes: np.ndarray) -> np.ndarray:
    """For each of the bins of distinct hashes, whether it holds an odd number of them."""
    bins = (hashes.view(np.uint64) % np.uint64(64 * PARITY)).astype(np.int64)
    return np.bincount(bins, minlength=64 * PARITY) % 2 == 1


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def _signatures(rows: DataFrame, id_col: str, plan: Plan) -> DataFrame:
    """RID, id, ``key`` (equal for equal sets), ``n`` (the set's size) and ``bits``: the bits in no block and the parities, 64 at a time, the set's size, then the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, blocks = plan.width, plan.blocks
        weights = np.left_shift(np.int64(1), np.arange(width, dtype=np.int64))
        for batch in batches:
            keys, sizes, values = [], [], []
            for text in batch.column(2).to_pylist():
                s = shingle_set(text, plan.shingle)
                bits = fingerprint_bits(s, 64 * SIGNS + width * blocks)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sizes.append(len(s))
                check = np.packbits(np.concatenate((bits[: 64 * SIGNS], bin_parities(s))), bitorder="little").view("<i8")
                values.append(np.concatenate((check, [len(s)], bits[64 * SIGNS :].reshape(blocks, width) @ weights)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), _lists(values)], [RID, "id", "key", "n", "bits"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(RID, F.col(f"`{id_col}`"), F.col(f"`{plan.text_col}`").cast("binary")).mapInArrow(run, f"{RID} long, id {kind}, key binary, n long, bits array<long>")


def _sets(rows: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """RID and ``set``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingle_set(t, shingle) for t in batch.column(1).to_pylist()])], [RID, "set"])

    return rows.select(RID, F.col(f"`{text_col}`").cast("binary")).mapInArrow(run, f"{RID} long, set array<long>")


def _differ(a: str, b: str, places: Iterable[int]) -> Column:
    """The number of bits in which two columns of numbers differ at some places."""
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in places), F.lit(0))


@dataclass(frozen=True)
class Plan:
    width: int
    blocks: int
    percent: int
    shingle: int = 5
    text_col: str = "text"

    def close(self, a: str, b: str) -> Column:
        """Whether two columns of bits differ in no more places than sets at the similarity may, and in no more parities than they can."""
        n, p = 64 * SIGNS + self.width * self.blocks, bit_difference(self.percent / 100)
        differ = _differ(a, b, [*range(SIGNS), *range(CHECK, CHECK + self.blocks)])
        sizes = F.get(a, F.lit(CHECK - 1)).cast("double") + F.get(b, F.lit(CHECK - 1)).cast("double")
        at_least = _differ(a, b, range(SIGNS, SIGNS + PARITY))
        return (differ <= math.ceil(n * p + 3 * math.sqrt(n * p * (1 - p)))) & (at_least * (100 + self.percent) <= sizes * (100 - self.percent))

    def alike(self, a: str, b: str) -> Column:
        """Whether the first ``PEEK`` 64 bits of two columns of bits look close: five standard deviations are allowed, so it leaves what ``close`` finds."""
        n, p = 64 * PEEK, bit_difference(self.percent / 100)
        return _differ(a, b, range(PEEK)) <= math.ceil(n * p + 5 * math.sqrt(n * p * (1 - p)))

    def meet_first(self, a: str, b: str, variant: Column) -> Column:
        """Whether of all variants at which the balls of two columns of bits meet this is the one that counts: in the first such block, the smaller."""
        pos = F.shiftrightunsigned(variant, self.width).cast("int")
        far = [(F.lit(k) >= pos) | (F.bit_count(F.get(a, F.lit(CHECK + k)).bitwiseXOR(F.get(b, F.lit(CHECK + k)))) > 2) for k in range(self.blocks)]
        x, y = F.get(a, pos + CHECK), F.get(b, pos + CHECK)
        low = x.bitwiseXOR(y).bitwiseAND(-x.bitwiseXOR(y))
        here = F.least(x.bitwiseXOR(low), y.bitwiseXOR(low)) == variant.bitwiseAND(F.lit((1 << self.width) - 1))
        return reduce(lambda p, q: p & q, far, here)


def _close(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose bits are close."""
    one = pairs.join(nodes.select(F.col("node").alias("a"), F.col("bits").alias("bits_a")).hint("merge"), "a")
    other = nodes.select(F.col("node").alias("__b"), F.col("bits").alias("bits_b")).hint("merge")
    return one.join(other, (F.col("b") == F.col("__b")) & plan.close("bits_a", "bits_b")).select("a", "b")


def _verified(near: DataFrame, rows: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough, written."""
    near = materialize(near.distinct(), "near")
    ends = near.select(F.explode(F.array("a", "b")).alias(RID)).distinct()
    sets = materialize(_sets(rows.join(ends, RID, "left_semi"), plan.text_col, plan.shingle), "sets")
    one = near.join(sets.select(F.col(RID).alias("a"), F.col("set").alias("set_a")).hint("merge"), "a")
    other = sets.select(F.col(RID).alias("__b"), F.col("set").alias("set_b")).hint("merge")
    overlap = F.size(F.array_intersect("set_a", "set_b"))
    similar = overlap * (100 + plan.percent) >= (F.size("set_a") + F.size("set_b")) * plan.percent
    links = materialize(one.join(other, (F.col("b") == F.col("__b")) & similar).select("a", "b"), "links")
    discard(near, sets)
    return links


def _with_component(df: DataFrame, comp: DataFrame, at: str, name: str) -> DataFrame:
    named = df.join(comp.select(F.col("node").alias(at), F.col("component").alias(name)), at, "left")
    return named.withColumn(name, F.coalesce(name, at))


def _values(nodes: DataFrame, plan: Plan, first: int, many: int, *keep: str) -> DataFrame:
    """``token`` of each of the blocks first, ..., first + many - 1: its number above its value."""
    block = F.posexplode(F.slice("bits", CHECK + first + 1, many)).alias("pos", "value")
    return nodes.select(*keep, block).select(*keep, (F.shiftleft((F.col("pos") + first).cast("long"), plan.width) + F.col("value")).alias("token"))


def _equal_blocks(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of every node with the first node, in each of the orders, of each of its blocks."""
    visits = _values(nodes, plan, 0, plan.blocks, "node")
    first = [F.min(F.col("node").bitwiseXOR(F.lit(o))).bitwiseXOR(F.lit(o)) for o in ORDERS]
    hubs = materialize(visits.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.array(*first).alias("hubs")).filter("n > 1").select("token", "hubs"), "hubs")
    stars = visits.join(hubs, "token").select("node", F.explode(F.array_remove(F.array_distinct("hubs"), F.col("node"))).alias("hub"))
    return stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _named(nodes: DataFrame, comp: DataFrame) -> DataFrame:
    """node, bits, c (its component) and o, a number that tells both: 32 bits of a hash of the component above 32 of the node."""
    high, low = F.lit(-(1 << 32)), F.lit((1 << 32) - 1)
    o = F.xxhash64("c").bitwiseAND(high).bitwiseOR(F.xxhash64("node").bitwiseAND(low))
    return _with_component(nodes.select("node", "bits"), comp, "node", "c").withColumn("o", o)


def _apart(a: str, b: str) -> Column:
    """Whether two numbers o are of different components."""
    return F.shiftrightunsigned(F.col(a).bitwiseXOR(F.col(b)), 32) != 0


def _masks(plan: Plan) -> list[int]:
    """What turns a block into the members of its ball: no bit flipped, or one."""
    return [0, *(1 << k for k in range(plan.width))]


def _classes(nodes: DataFrame, plan: Plan) -> DataFrame:
    """Of each token: its number of nodes, and the smallest and largest o of them. nodes: as ``_named`` gives them."""
    tokens = _values(nodes, plan, 0, plan.blocks, "o")
    return materialize(tokens.groupBy("token").agg(F.min("o").alias("lo"), F.max("o").alias("hi"), F.count(F.lit(1)).alias("m")), "classes")


def _meetings(classes: DataFrame, plan: Plan, first: int, many: int, tasks: int) -> tuple[DataFrame, DataFrame]:
    """Where the balls of the blocks first, ..., first + many - 1 meet: pairs (oa, ob), and (variant, token, lo, hi) of the classes at crowded variants.

    The pairs are of the smallest and the largest visitor of each variant, so all there are where two
    meet. Variants with visitors of one component only are left out: the order of o is first one of
    components. A variant has no more classes than a ball has members.
    """
    block = F.shiftrightunsigned("token", plan.width)
    here = classes.filter((block >= first) & (block < first + many))
    # A visit tells its visitor by one bit, for the place that is flipped; a class of several components visits itself once more.
    ball = F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(1 << k).cast("long").alias("bit")) for k, m in enumerate(_masks(plan))))
    again = F.when((F.col("flip.mask") == 0) & _apart("lo", "hi"), F.lit(1 << plan.width + 1)).otherwise(F.lit(0)).cast("long")
    spread = here.select("token", "lo", "hi").repartition(tasks, "token")  # every row becomes a ball
    visits = spread.select("token", "lo", "hi", F.explode(ball).alias("flip")).select(F.col("token").bitwiseXOR(F.col("flip.mask")).alias("variant"), F.col("flip.bit").bitwiseOR(again).alias("who"))
    met = materialize(visits.groupBy("variant").agg(F.bit_or("who").alias("who")).filter(F.bit_count("who") > 1), "variants")
    visitors = met.select("variant", F.explode(F.filter(ball, lambda f: F.col("who").bitwiseAND(f["bit"]) != 0)).alias("flip"))
    of = materialize(visitors.select("variant", F.col("variant").bitwiseXOR(F.col("flip.mask")).alias("token")).join(here, "token"), "visits")
    ends = of.groupBy("variant").agg(F.min("lo").alias("oa"), F.max("hi").alias("ob"), F.sum("m").alias("n")).filter(_apart("oa", "ob"))
    ends = materialize(ends, "ends")
    crowded = materialize(of.join(ends.filter("n > 2").select("variant"), "variant", "left_semi").select("variant", "token", "lo", "hi"), "crowded")
    pairs = materialize(ends.select("oa", "ob").distinct(), "pairs")
    discard(met, of, ends)
    return pairs, crowded


def _stars(pairs: DataFrame, of: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """Close pairs (a, b): those that meet alone, and the ends of classes with their variant's smallest and largest, in different components."""
    ends = materialize(of.groupBy("variant").agg(F.min("lo").alias("x"), F.max("hi").alias("y")), "hubs")
    both = F.array(*(F.struct(F.col(o).alias("o"), F.col(h).alias("hub")) for o in ("lo", "hi") for h in ("x", "y")))
    star = of.join(ends, "variant").select(F.explode(F.array_distinct(F.filter(both, lambda p: F.shiftrightunsigned(p["o"].bitwiseXOR(p["hub"]), 32) != 0))).alias("p"))
    pairs = pairs.unionByName(star.select(F.least("p.o", "p.hub").alias("oa"), F.greatest("p.o", "p.hub").alias("ob"))).distinct()
    peek = nodes.select("o", "node", F.slice("bits", 1, PEEK).alias("bits"))
    one = pairs.join(peek.select(F.col("o").alias("oa"), F.col("node").alias("x"), F.col("bits").alias("bits_x")).hint("merge"), "oa")
    both = one.join(peek.hint("merge"), (F.col("ob") == F.col("o")) & plan.alike("bits_x", "bits"))
    return _close(both.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct(), nodes, plan)


def _members(of: DataFrame, nodes: DataFrame, comp: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The classes at crowded variants, as (token, m, d, md): nodes, largest component, nodes of it; and their nodes (token, node, c, m, top, bits)."""
    seen = materialize(of.select("token").distinct(), "tokens")
    lean = _with_component(_values(nodes, plan, 0, plan.blocks, "node").join(seen, "token", "left_semi"), comp, "node", "c")
    lean = materialize(lean, "lean")
    most = F.max(F.struct("k", "c"))
    classes = lean.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(F.sum("k").alias("m"), most.alias("top"))
    classes = materialize(classes.select("token", "m", F.col("top.c").alias("d"), F.col("top.k").alias("md")), "classes")
    of_class = lean.join(classes, "token").select("token", "node", "c", "m", (F.col("c") == F.col("d")).alias("top"))
    members = materialize(of_class.join(nodes.select("node", "bits").hint("merge"), "node"), "members")
    discard(seen, lean)
    return classes, members


def _parts(of: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """What is to be compared where a class of several nodes takes part: (variant, p, p_top, q, q_top), the smaller part first.

    A class has two parts, the nodes of its largest component and all others, so that classes that are
    nearly one component meet without comparing it with itself. Two classes count at one of the two
    variants where they meet.
    """
    at = materialize(of.select("variant", "token").join(classes, "token"), "at")
    names = ("token", "m", "d", "md")
    x, y = (at.select(F.col("variant").alias(f"v{k}"), *(F.col(n).alias(f"{n}{k}") for n in names)) for k in "xy")
    differ = F.col("tokenx").bitwiseXOR(F.col("tokeny"))
    low = differ.bitwiseAND(-differ)
    counts = F.least(F.col("tokenx").bitwiseXOR(low), F.col("tokeny").bitwiseXOR(low)) == F.col("vx")
    once = F.when(F.col("my") > 1, F.col("tokenx") < F.col("tokeny")).otherwise(F.col("tokenx") != F.col("tokeny"))
    one = (F.col("dx") == F.col("dy")) & (F.col("mdx") == F.col("mx")) & (F.col("mdy") == F.col("my"))
    two = x.filter("mx > 1").join(y, (F.col("vx") == F.col("vy")) & once & counts & ~one)

    def pair(a: bool, b: bool) -> Column:
        na, nb = (F.col(f"md{k}") if top else F.col(f"m{k}") - F.col(f"md{k}") for k, top in (("x", a), ("y", b)))
        forth, back = (F.struct(F.col(f"token{k}").alias("p"), F.lit(s).alias("p_top"), F.col(f"token{j}").alias("q"), F.lit(t).alias("q_top")) for k, s, j, t in (("x", a, "y", b), ("y", b, "x", a)))
        needed = (F.col("dx") != F.col("dy")) if a and b else (na > 0) & (nb > 0)
        return F.when(needed, F.when(na <= nb, forth).otherwise(back))

    parts = two.select(F.col("vx").alias("variant"), F.explode(F.array_compact(F.array(*(pair(a, b) for a in (True, False) for b in (True, False))))).alias("z")).select("variant", "z.*")
    within = classes.filter("md < m").select(F.col("token").alias("variant"), F.col("token").alias("p"), F.lit(False).alias("p_top"), F.col("token").alias("q"), F.explode(F.array(F.lit(True), F.lit(False))).alias("q_top"))
    return parts.unionByName(within)


def _between(of: DataFrame, nodes: DataFrame, comp: DataFrame, plan: Plan) -> DataFrame:
    """All close pairs of visitors of one variant that are in different components, each once."""
    classes, members = _members(of, nodes, comp, plan)
    alone = materialize(of.select("variant", "token").join(members.filter("m = 1").select("token", "node", "c", "bits"), "token").select("variant", "node", "c", "bits"), "alone")
    x = alone.select(F.col("variant").alias("v"), F.col("node").alias("x"), F.col("c").alias("cx"), F.col("bits").alias("bits_x"))
    close = (F.col("cx") != F.col("c")) & plan.meet_first("bits_x", "bits", F.col("v")) & plan.close("bits_x", "bits")
    pairs = x.join(alone, (F.col("v") == F.col("variant")) & (F.col("x") < F.col("node")) & close).select("x", "node")
    parts = materialize(_parts(of, classes, plan), "parts")
    one = parts.withColumnRenamed("variant", "v").join(
        members.select(F.col("token").alias("p"), F.col("top").alias("p_top"), F.col("node").alias("x"), F.col("c").alias("cx"), F.col("bits").alias("bits_x")), ["p", "p_top"]
    )
    both = (F.col("q") == F.col("token")) & (F.col("q_top") == F.col("top"))
    twice = (F.col("p") == F.col("q")) & (F.col("p_top") == F.col("q_top")) & (F.col("x") >= F.col("node"))
    more = one.join(members.select("token", "top", "node", "c", "bits"), both & ~twice & close).select("x", "node")
    return pairs.unionByName(more).select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))


def similar_components(rows: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """(node, component) of the nodes that links reach. rows: RID and the text; nodes: node (a RID) and bits."""
    links = _verified(_close(_equal_blocks(nodes, plan), nodes, plan), rows, plan)
    now = materialize(_named(nodes, connected_components(links)), "nodes")
    classes, tasks = _classes(now, plan), tasks_for(now.count(), SPREAD)
    pairs, of = zip(*(_meetings(classes, plan, k, min(AT_ONCE, plan.blocks - k), tasks) for k in range(0, plan.blocks, AT_ONCE)), strict=True)
    visits = reduce(DataFrame.unionByName, of)
    links = links.unionByName(_verified(_stars(reduce(DataFrame.unionByName, pairs), visits, now, plan), rows, plan))
    comp = connected_components(links)
    links = links.unionByName(_verified(_between(visits, nodes, comp, plan), rows, plan))
    discard(now, classes, *pairs, *of)
    return connected_components(links)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each group of documents that shingle sets of Jaccard similarity ``percent`` / 100 or more connect: the one with the smallest id (nulls last), then the first row."""
    small_batches(docs.sparkSession)
    rows = stable_rows(docs)
    width, blocks = layout(rows.count(), percent / 100, recall)
    plan = Plan(width, blocks, percent, shingle, text_col)
    sigs = materialize(_signatures(rows, id_col, plan), "fingerprints")
    groups = materialize(sigs.groupBy("key").agg(F.min(RID).alias("node")), "groups")
    nodes = materialize(sigs.filter("n > 0").select(F.col(RID).alias("node"), "bits").join(groups.select("node"), "node", "left_semi"), "nodes")
    comp = similar_components(rows, nodes, plan)
    named = materialize(_with_component(groups, comp, "node", "component").select("key", "component"), "names")
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col(RID).alias("rid"))
    kept = sigs.select(RID, "id", "key").join(named, "key").groupBy("component").agg(F.min(first).alias("first")).select(F.col("first.rid").alias(RID))
    gone = materialize(sigs.select(RID).join(kept, RID, "left_anti"), "gone")  # fewer than those that stay
    discard(sigs, groups, nodes, named)
    return rows.join(gone, RID, "left_anti").drop(RID)
