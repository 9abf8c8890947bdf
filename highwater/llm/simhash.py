"""Operator 11: near-duplicates by SimHash fingerprints, joined on pigeonhole blocks.

A fingerprint has a bit for every bit of the shingles' XXH64: 1 where over half of the shingles, repeats
included, have it set. Two fingerprints link at DISTANCE or fewer differing bits. With the 64 bits split into b
blocks, such a pair differs in DISTANCE blocks at most and so agrees in b - DISTANCE whole ones: every fingerprint
is posted under the blocks of each such choice, and pairs are looked for under equal keys only. The more
fingerprints there are the more blocks, so that a key holds few strangers (``blocks_for``).

Equal fingerprints are one node from the start. Under a key of two the pair is verified as it is. Under a key of
more, every member is first verified against one of them, the hub, which costs a row per member; the connected
parts of that come next, and only keys that hold several parts go on. There the members outside the key's
largest part meet all others, in blocks of BLOCK. Nothing is compared within a part, and no task gets a key of more
than two blocks whole.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join
from highwater.llm.common import components, partitions, ship
from highwater.llm.words import Words, chunks, words

WORDS = 4
SEED = 42
BITS = 64
DISTANCE = 4
LEAST_BLOCKS = 6
#: Members of a key that meet in one task, and shingles whose bits are spread out together.
BLOCK = 1024
PIECE = 1 << 16


def _spaced(found: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space after each, and where they begin and end there."""
    lengths = found.ends - found.starts + 1
    ends = np.cumsum(lengths)
    starts = ends - lengths
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    mask = np.zeros(len(found.data) + 1, np.int8)
    mask[found.starts] += 1
    mask[found.ends] -= 1
    out[inside] = found.data[np.cumsum(mask[:-1], dtype=np.int8) > 0]
    return out.tobytes(), starts, ends - 1


def _shingles(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and owner of every shingle; fewer than WORDS words are one shingle."""
    many = np.where(found.counts >= WORDS, found.counts - WORDS + 1, np.minimum(found.counts, 1))
    owner = np.repeat(np.arange(found.rows), many)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    first = found.first[:-1][owner] + place
    return first, first + np.minimum(found.counts, WORDS)[owner] - 1, owner


def fingerprints(found: Words) -> np.ndarray:
    """The fingerprint of each document, zero without words."""
    data, starts, ends = _spaced(found)
    first, last, owner = _shingles(found)
    held = np.zeros((found.rows, BITS), np.int64)
    for at in range(0, len(owner), PIECE):
        part = slice(at, at + PIECE)
        ranges = zip(starts[first[part]].tolist(), ends[last[part]].tolist(), strict=True)
        h = np.array([xxh64_intdigest(data[a:b], SEED) for a, b in ranges], np.uint64)
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, BITS)
        of = owner[part]
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        held[of[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    total = np.bincount(owner, minlength=found.rows)
    ones = 2 * held > total[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint(batches):
    """(doc_id, fp) of (doc_id, text)."""
    for batch in batches:
        for part, texts in chunks(batch):
            fp = pa.array(fingerprints(words(texts)).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), fp], ["doc_id", "fp"])


def blocks_for(fingerprints_: int) -> int:
    """The least number of blocks whose keys have at least as many values as there are fingerprints."""
    b = LEAST_BLOCKS
    while 2 ** (BITS * (b - DISTANCE) // b) < fingerprints_ and b < 12:
        b += 1
    return b


def masks(blocks: int) -> list[int]:
    """The bits of every choice of ``blocks`` - DISTANCE blocks."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [sum(chosen) for chosen in combinations(each, blocks - DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _posted(nodes: DataFrame, blocks: int) -> DataFrame:
    """(choice, key, fp): every fingerprint under each of its keys."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks(blocks)])
    return nodes.select(F.posexplode(keys).alias("choice", "key"), "fp")


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _unsettled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """(choice, key, i, j, fp, part): members of keys that hold several parts, in the blocks that meet.

    Members of the key's largest part are dealt to blocks 0 to kc - 1, all others to the kr blocks after them; the
    latter meet everything. A key of up to BLOCK members is one block.
    """
    key = ["choice", "key"]
    placed = members.join(parts, members.fp == parts.node, "left")
    placed = placed.select(*key, "fp", F.coalesce("part", "fp").alias("part"))
    sizes = placed.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("c"))
    core = sizes.groupBy(*key).agg(F.max(F.struct("c", "part")).alias("core"), F.sum("c").alias("m"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    whole = F.col("m") <= BLOCK
    open_ = core.where("core.c < m").select(
        *key,
        F.col("core.part").alias("largest"),
        F.when(whole, F.lit(0)).otherwise(blocks(F.col("core.c"))).alias("kc"),
        F.when(whole, F.lit(1)).otherwise(blocks(F.col("m") - F.col("core.c"))).alias("kr"),
    )
    dealt = split_join(placed, open_, key, "inner")
    inside, order = (F.col("part") == F.col("largest")) & (F.col("kc") > 0), F.xxhash64("fp", F.lit(3))
    x = F.when(inside, F.pmod(order, F.col("kc"))).otherwise(F.col("kc") + F.pmod(order, F.col("kr")))
    first = F.when(inside, F.col("kc")).otherwise(F.lit(0))
    meet = F.transform(
        F.sequence(first, F.col("kc") + F.col("kr") - 1),
        lambda y: F.struct(F.least(F.col("x"), y).alias("i"), F.greatest(F.col("x"), y).alias("j")),
    )
    met = dealt.withColumn("x", x.cast("int")).withColumn("ij", F.explode(meet))
    return met.select(*key, "ij.i", "ij.j", "fp", "part")


def connect(fp: np.ndarray, part: np.ndarray) -> tuple[list[int], list[int]]:
    """Links between different parts, as many as connect them all."""
    a, b, label = [], [], part.copy()
    for k in range(len(fp)):
        away = np.bitwise_count(fp ^ fp[k])
        for other in np.unique(label[(away <= DISTANCE) & (label != label[k])]):
            a.append(int(label[k]))
            b.append(int(other))
            label[label == other] = label[k]
    return a, b


def _verified(batches):
    """(a, b) of rows sorted by choice, key, i and j; columns as of ``_unsettled``."""
    held: list[pa.RecordBatch] = []

    def linked(rows: pa.Table):
        keys = np.stack([rows.column(i).to_numpy() for i in range(4)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        fp, part = rows["fp"].to_numpy().astype(np.int64).view(np.uint64), rows["part"].to_numpy()
        a, b = [], []
        for x, y in zip(np.split(fp, cuts), np.split(part, cuts), strict=True):
            more = connect(x, y)
            a += more[0]
            b += more[1]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = pa.Table.from_batches([*held, batch])
        same = np.ones(rows.num_rows, bool)
        for i in range(4):
            column = rows.column(i).to_numpy()
            same &= column == column[-1]
        last = int(np.argmax(same))
        if last:
            yield linked(rows.slice(0, last))
        held = rows.slice(last).combine_chunks().to_batches()
    if held:
        yield linked(pa.Table.from_batches(held))


def linked_fingerprints(nodes: DataFrame) -> DataFrame:
    """(node, root): distinct fingerprints ``fp`` that links connect, by the smallest."""
    spark = nodes.sparkSession
    posted = _posted(nodes, blocks_for(nodes.count()))
    key = ["choice", "key"]
    keys = posted.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("hub"), F.max("fp").alias("other"))
    shared = materialise(keys.where("n > 1"), "shared")
    pairs = shared.where((F.col("n") == 2) & _near("hub", "other")).select(F.col("hub").alias("a"), F.col("other").alias("b"))
    large = shared.where("n > 2").select(*key, "hub")
    members = materialise(split_join(posted, large, key, "inner"), "members")
    spokes = members.where((F.col("fp") != F.col("hub")) & _near("fp", "hub"))
    linked = components(pairs.unionByName(spokes.select(F.col("hub").alias("a"), F.col("fp").alias("b"))))
    parts = linked.select("node", F.col("root").alias("part"))
    rest = materialise(_unsettled(members.drop("hub"), parts), "unsettled")
    if rest.isEmpty():
        return linked
    together = rest.repartition(partitions(spark), *key, "i", "j").sortWithinPartitions(*key, "i", "j")
    more = together.mapInArrow(_verified, "a bigint, b bigint")
    return components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id that links reach, the row's own included. A null or empty text, or one
    without words, has fingerprint zero and is linked like any other, so all of them are linked to each other.
    Fewer than four words are one shingle. Repeated rows and ids stay rows; a null id stays null and counts only
    where its whole component has no other. An empty table gives no rows. Extra columns are not read and may
    have any name.
    """
    ship(docs.sparkSession)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, fp bigint"
    described = materialise(docs.select("doc_id", "text").mapInArrow(_fingerprint, schema), "fingerprints")
    nodes = materialise(described.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    linked = linked_fingerprints(nodes.select("fp"))
    placed = nodes.join(linked, nodes.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = split_join(placed.select("fp", "root"), named, ["root"], "inner").select("fp", "component_id")
    out = split_join(described, placed, ["fp"], "inner")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
