"""Operator 4: language-model scores by logistic mixing of hashed-context bit predictors.

A token is coded in binary decisions: does it repeat the token before it, and if not, the bits of its
class in a Huffman code. The commonest words are classes of their own; all others share classes by
their shape (first and last bytes, length), and within such a class a word has its share of the counts.

Every bit is predicted by several tables of counts, looked up by a hash of the bit's place in the code and
a context: nothing, the last guide word (one of the commonest, which tells the language), the group of the
token before, and both. The predictions are stretched, weighted (the weights are gated by depth and trained
online, batch after batch) and squashed; a last table, by the mixed prediction and the guide word, refines
the result adaptively. The sum over all bits of a token is its prediction by the tables.

This is then mixed with two predictors that grow with the corpus: how often the token followed the one token
before it, and the two before it, counted for all such pairs and triples without a limit. The share of each is a
gate by how often both contexts were seen. A training text is scored without its own pairs and triples. The sum over
all tokens is the text's total, also given in bits per byte.

Counts come from all training documents. All words, pairs and triples are counted and answered in one exchange:
texts are dealt to chunks, a chunk sends every bucket of hashes one sorted, packed list of those it asks for with its
own training counts, the bucket adds the lists up (that is the vocabulary and the counts) and sends each back its totals,
mostly a byte each. The bits of the tables are expanded and summed on Spark, context by context; of them only sums
reach the driver, a bounded number. What is broadcast (SINGLES words, a prediction per class and context) has a
fixed size. The weights, the refinement and the gates are trained on a tenth of the training documents, with tables, pairs
and triples that have not seen them. Pairs and triples are known by as many bits as leave one in COLLISION that is taken
for another; words have 64.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.llm.common import release, ship, shuffles_removed
from highwater.llm.words import Index, Words, chunks, mix, words

FOLDS = 10
MIXER_FOLD = 1
SINGLES = 2_047  # words that are classes of their own
SHAPES = 2_048
GUIDES = 16
PREVIOUS = 24  # words that are previous-token groups of their own
GROUPS = 32
SLOTS = 1 << 21
DEPTHS = 24
PRIOR = 2.0
SMOOTH = 0.1
END = np.uint64(0x0E4D0F7E3A5B9C11)  # stands for the end of a text
FLUSH = 2_000_000
START = np.uint64(0x3C6EF372FE94F82B)  # stands before a text
LEVELS = 32  # gates of pairs and of triples, by the logarithms of the counts of both contexts
BINS = 128
#: Bytes of a chunk's texts and hashes of a bucket, about.
CHUNK = 6 << 20
BUCKET = 2_000_000
#: Of so many different pairs and triples one may be taken for another.
COLLISION = 10_000


def shapes(found: Words) -> np.ndarray:
    size = found.ends - found.starts
    first, last = found.data[found.starts], found.data[found.ends - 1]
    before = found.data[np.maximum(found.ends - 2, found.starts)]
    key = first.astype(np.uint64) | last.astype(np.uint64) << np.uint64(8) | before.astype(np.uint64) << np.uint64(16)
    key |= np.minimum(size // 3, 4).astype(np.uint64) << np.uint64(24)
    return (mix(key) % np.uint64(SHAPES)).astype(np.int64)


@dataclass
class Code:
    """Classes of tokens and their Huffman code."""

    singles: Index
    single: np.ndarray  # the class of each, and -1 for all other words
    nodes: np.ndarray  # classes x DEPTH: the node of each bit
    bits: np.ndarray
    lengths: np.ndarray
    log_class: np.ndarray  # log10 of the smoothed size of each class; 0 for single words
    tokens: int
    distinct: int

    def classes(self, hashes: np.ndarray, shape: np.ndarray) -> np.ndarray:
        single = self.single[self.singles.find(hashes)]
        return np.where(single >= 0, single, SINGLES + shape)


def _huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(counts)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
    for node in range(n, 2 * n - 1):
        for bit in (0, 1):
            c, child = heapq.heappop(heap) if bit == 0 else heapq.heapreplace(heap, (c + heap[0][0], node))
            parent[child], side[child] = node, bit
    paths = []
    for leaf in range(n):
        path, at = [], leaf
        while at != 2 * n - 2:
            path.append((parent[at] - n, side[at]))
            at = parent[at]
        paths.append(path[::-1])
    depth = max(map(len, paths))
    nodes, bits = np.zeros((n, depth), np.int64), np.zeros((n, depth), np.int8)
    for leaf, path in enumerate(paths):
        for d, (node, bit) in enumerate(path):
            nodes[leaf, d], bits[leaf, d] = node, bit
    return nodes, bits, np.array([len(p) for p in paths])


def make_code(vocabulary: DataFrame) -> Code:
    """From (h, shape, c) of every word; an end is always a class of its own."""
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    end = int(END.astype(np.int64))
    top = vocabulary.where(F.col("h") != end).orderBy(F.desc("c"), "h").limit(SINGLES - 1)
    ends = vocabulary.where(F.col("h") == end).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first().c
    rows = sorted([(-r.c, r.h) for r in top.collect()] + [(-ends, end)])
    names = np.array([h for _, h in rows], np.int64)
    size, kinds = np.zeros(SINGLES + SHAPES), np.zeros(SINGLES + SHAPES)
    size[: len(rows)] = [-c for c, _ in rows]
    rest = vocabulary.where(~F.col("h").isin([int(x) for x in names]))
    for r in rest.groupBy("shape").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        size[SINGLES + r["shape"]], kinds[SINGLES + r["shape"]] = r.c, r.v
    order = np.argsort(names.view(np.uint64))
    nodes, bits, lengths = _huffman(np.maximum(size, 0.5) * 2)
    log_class = np.log10(size + SMOOTH * (kinds + 1))
    log_class[:SINGLES] = 0
    known = Index(names.view(np.uint64)[order])
    return Code(known, np.append(order, -1), nodes, bits, lengths, log_class, int(total), int(distinct))


@dataclass
class Events:
    """What the tokens of a chunk (with ends) are to the model, one entry per token."""

    owner: np.ndarray
    classes: np.ndarray
    guide: np.ndarray
    group: np.ndarray
    run: np.ndarray  # how often the token before was a repetition, up to 3
    repeats: np.ndarray


def events(code: Code, found: Words) -> Events:
    rows = found.rows
    n = len(found.hashes) + rows
    ends = found.first[1:] + np.arange(rows)
    is_end = np.zeros(n, bool)
    is_end[ends] = True
    hashes, shape = np.full(n, END), np.zeros(n, np.int64)
    hashes[~is_end], shape[~is_end] = found.hashes, shapes(found)
    owner = np.repeat(np.arange(rows), found.counts + 1)
    classes = code.classes(hashes, shape)
    start = np.ones(n, bool)
    start[1:] = is_end[:-1]
    # The last guide word before each token of its text: its place, carried on.
    position = np.arange(n)
    marks = np.where((classes < GUIDES) & ~is_end, position + 1, 0)
    marks = np.maximum.accumulate(np.concatenate([[0], marks[:-1]]))
    first = (found.first[:-1] + np.arange(rows))[owner]
    guide = np.where(marks > first, classes[np.maximum(marks - 1, 0)] + 1, 0)
    before = np.concatenate([[0], classes[:-1]])
    group = np.where(before < PREVIOUS, before + 1, PREVIOUS + 1 + before % (GROUPS - PREVIOUS - 1))
    group[start] = 0
    same = np.zeros(n, bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[start] = False
    breaks = np.maximum.accumulate(np.where(same, 0, position))
    length = position - breaks  # repetitions up to and with this token
    run = np.minimum(np.concatenate([[0], length[:-1]]), 3)
    run[start] = 0
    return Events(owner, classes, guide, group, run, same)


def _key(e: Events, fold) -> np.ndarray:
    """A number for what the model needs of a token; repetitions need no class."""
    classes = np.where(e.repeats, 0, e.classes)
    key = ((classes * (GUIDES + 1) + e.guide) * GROUPS + e.group) * 4 + e.run
    return (key * 2 + e.repeats) * 2 + fold


def _split(key: np.ndarray):
    key, fold = key // 2, key % 2
    key, repeats = key // 2, key % 2 == 1
    key, run = key // 4, key % 4
    key, group = key // GROUPS, key % GROUPS
    return key // (GUIDES + 1), key % (GUIDES + 1), group, run, repeats, fold


def _observations(code):
    """(key, c) of (grp, text), summed as far as a task holds them."""

    def run(batches):
        held, rows = [], 0

        def out():
            keys, c = (np.concatenate(x) for x in zip(*held, strict=True))
            names, inverse = np.unique(keys, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(np.bincount(inverse, c).astype(np.int64))], ["key", "c"]
            )

        for batch in batches:
            for part, texts in chunks(batch):
                e = events(code.value, words(texts))
                fold = (part.column(0).to_numpy(zero_copy_only=False) == APART).astype(np.int64)
                keys, c = np.unique(_key(e, fold[e.owner]), return_counts=True)
                held.append((keys, c))
                rows += len(keys)
                if rows > FLUSH:
                    yield out()
                    held, rows = [], 0
        if held:
            yield out()

    return run


def _slot(kind: int, context, node) -> np.ndarray:
    key = (np.asarray(context).astype(np.uint64) << np.uint64(16)) + np.asarray(node).astype(np.uint64)
    return (mix(key * np.uint64(8) + np.uint64(kind)) & np.uint64(SLOTS - 1)).astype(np.int64)


REPEAT_NODE = SINGLES + SHAPES + 1  # beyond all nodes of the code
NODES = REPEAT_NODE + 1
CONTEXTS = (GUIDES + 1) * GROUPS
INPUTS = 4
_SUMS = "fold int, both int, run int, node int, one double, zero double"


def _expanded(code):
    """The bits of all observations of one context (guide and group), summed. Columns of ``_SUMS``."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        known = code.value
        classes, guide, group, run_, repeats, fold = _split(t["key"].to_numpy())
        c = t["c"].to_numpy().astype(float)
        both = int(guide[0]) * GROUPS + int(group[0])
        rows = []

        def add(of, bit, place, width):
            """Sums of a bit over ``place``, fold by fold."""
            at = fold[of] * width + place
            one, zero = (np.bincount(at, c[of] * x, 2 * width) for x in (bit, ~bit))
            found = np.flatnonzero(one + zero)
            return found // width, found % width, one[found], zero[found]

        every = np.arange(len(c))
        f, r, one, zero = add(every, repeats, run_, 4)
        rows.append((f, r, np.full(len(f), REPEAT_NODE), one, zero))
        open_ = np.flatnonzero(~repeats)
        for depth in range(known.nodes.shape[1]):
            open_ = open_[known.lengths[classes[open_]] > depth]
            bit, node = known.bits[classes[open_], depth] == 1, known.nodes[classes[open_], depth]
            f, n, one, zero = add(open_, bit, node, NODES)
            rows.append((f, np.zeros(len(f), np.int64), n, one, zero))
        f, r, n, one, zero = (np.concatenate(x) for x in zip(*rows, strict=True))
        whole = (f, np.full(len(f), both), r, n)
        return pa.table(
            [*(pa.array(x, pa.int32()) for x in whole), pa.array(one), pa.array(zero)],
            names=["fold", "both", "run", "node", "one", "zero"],
        )

    return run


def _slot(kind: int, context, node) -> np.ndarray:
    key = (np.asarray(context).astype(np.uint64) << np.uint64(16)) + np.asarray(node).astype(np.uint64)
    return (mix(key * np.uint64(8) + np.uint64(kind)) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass
class Sums:
    """Summed bits: how often a node was left by a one and by a zero, for each context and run."""

    both: np.ndarray
    run: np.ndarray
    node: np.ndarray
    one: np.ndarray
    zero: np.ndarray

    def where(self, keep) -> Sums:
        return Sums(*(x[keep] for x in (self.both, self.run, self.node, self.one, self.zero)))


class Mixer:
    """The tables, the weights and the refinement."""

    def __init__(self, code: Code):
        self.code = code
        self.zeros, self.ones = np.zeros((INPUTS, SLOTS), np.float32), np.zeros((INPUTS, SLOTS), np.float32)
        self.weights = np.zeros((DEPTHS + 1, INPUTS + 1))
        self.weights[:, 1:INPUTS] = 0.4
        self.refined = np.zeros((2, GUIDES + 1, 33)) + 1e-3
        self.gate = np.zeros(NODES, np.int64)  # by the node's depth
        self.gate[REPEAT_NODE] = DEPTHS
        for depth in range(code.nodes.shape[1]):
            self.gate[code.nodes[code.lengths > depth, depth]] = min(depth, DEPTHS - 1)

    def _slots(self, both, run, node):
        contexts = (run, both // GROUPS, both % GROUPS, both * 4 + run)
        return [_slot(k, context, node) for k, context in enumerate(contexts)]

    def count(self, s: Sums) -> None:
        for k, slot in enumerate(self._slots(s.both, s.run, s.node)):
            self.ones[k] += np.bincount(slot, s.one, SLOTS)
            self.zeros[k] += np.bincount(slot, s.zero, SLOTS)

    def inputs(self, both, run, node) -> np.ndarray:
        """Stretched predictions; a table with few counts leans on the one without context."""
        out = np.ones((INPUTS + 1, len(node)))
        base = None
        for k, slot in enumerate(self._slots(both, run, node)):
            one, zero = self.ones[k, slot].astype(float), self.zeros[k, slot].astype(float)
            p = (one + 0.2) / (one + zero + 0.4) if base is None else (one + PRIOR * base) / (one + zero + PRIOR)
            base = p if base is None else base
            p = np.clip(p, 1e-6, 1 - 1e-6)
            out[k] = np.log(p / (1 - p))
        return out

    @staticmethod
    def _place(z):
        x = np.clip(z, -7.99, 7.99) * 2 + 16
        low = x.astype(np.int64)
        return low, x - low

    def predict(self, both, run, node) -> tuple[np.ndarray, np.ndarray]:
        """The mixed stretched prediction, and the refined probability of a one."""
        x, guide = self.inputs(both, run, node), both // GROUPS
        z = np.clip((self.weights[self.gate[node]].T * x).sum(axis=0), -14, 14)
        p = 1 / (1 + np.exp(-z))
        low, part = self._place(z)
        curve = []
        for at in (low, low + 1):
            one, zero = self.refined[1, guide, at], self.refined[0, guide, at]
            centre = 1 / (1 + np.exp(-(at - 16) / 2))
            curve.append((one + 20 * centre) / (one + zero + 20))
        inside = np.abs(z) < 7.9
        refined = np.where(inside, (1 - part) * curve[0] + part * curve[1], p)
        return z, np.clip((p + refined) / 2, 1e-7, 1 - 1e-7)

    def learn(self, s: Sums, rounds: int = 3, batch: int = 8192) -> None:
        """Weights, online over batches, then the refinement of what they predict."""
        order = np.argsort(mix((s.node * CONTEXTS + s.both).astype(np.uint64)), kind="stable")
        order = order[np.argsort(self.gate[s.node[order]], kind="stable")]
        s = s.where(order)
        gates = self.gate[s.node]
        cuts = [0, *(np.flatnonzero(np.diff(gates)) + 1), len(gates)]
        for round_ in range(rounds):
            rate = 0.3 / (1 + round_)
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                for at in range(first, last, batch):
                    b = s.where(slice(at, min(at + batch, last)))
                    x, n = self.inputs(b.both, b.run, b.node), b.one + b.zero
                    gate, total = gates[at], n.sum()
                    p = 1 / (1 + np.exp(-np.clip(self.weights[gate] @ x, -14, 14)))
                    curve = (x * x) @ (n / total * p * (1 - p)) + 0.02
                    self.weights[gate] += rate * (x @ ((b.one - n * p) / total)) / curve
        for at in range(0, len(gates), 1 << 18):
            b = s.where(slice(at, at + (1 << 18)))
            z, _ = self.predict(b.both, b.run, b.node)
            low, part = self._place(z)
            for place, share in ((low, 1 - part), (low + 1, part)):
                np.add.at(self.refined, (1, b.both // GROUPS, place), b.one * share)
                np.add.at(self.refined, (0, b.both // GROUPS, place), b.zero * share)

    def table(self) -> Table:
        """What all tables, weights and refinements together say of every class and every repetition."""
        both, node = np.divmod(np.arange(CONTEXTS * NODES), NODES)
        bits = np.empty((2, CONTEXTS * NODES), np.float32)
        for at in range(0, len(node), 1 << 18):
            part = slice(at, at + (1 << 18))
            _, p = self.predict(both[part], np.zeros(len(node[part]), np.int64), node[part])
            bits[0, part], bits[1, part] = np.log10(1 - p), np.log10(p)
        bits = bits.reshape(2, CONTEXTS, NODES)
        classes = np.zeros((len(self.code.lengths), CONTEXTS), np.float32)
        for depth in range(self.code.nodes.shape[1]):
            rows = np.flatnonzero(self.code.lengths > depth)
            classes[rows] += bits[self.code.bits[rows, depth], :, self.code.nodes[rows, depth]]
        both, run = np.divmod(np.arange(CONTEXTS * 4), 4)
        _, p = self.predict(both, run, np.full(len(both), REPEAT_NODE))
        repeats = np.stack([np.log10(1 - p), np.log10(p)], axis=1).reshape(CONTEXTS, 4, 2).astype(np.float32)
        return Table(classes, repeats)


@dataclass
class Table:
    """The logarithm of a class after no repetition, and of a repetition or none, in every context."""

    classes: np.ndarray
    repeats: np.ndarray

    def gain(self, e: Events) -> np.ndarray:
        both = e.guide * GROUPS + e.group
        class_ = np.where(e.repeats, 0, self.classes[e.classes, both])
        return self.repeats[both, e.run, e.repeats.astype(np.int64)] + class_


def train(code: Code, sums: DataFrame) -> tuple[Table, Table]:
    """The table from the folds without the one apart, whose documents trained the weights, and that from all.

    ``sums`` has two rows at most for each node, context and run, so what comes to the driver has a fixed bound.
    """
    rows = sums.orderBy("fold", "both", "run", "node").toArrow()
    fold, *parts = (rows[c].to_numpy() for c in ("fold", "both", "run", "node", "one", "zero"))
    every, apart = Sums(*(x.astype(np.int64) for x in parts[:3]), *parts[3:]), fold == 1
    del rows, parts
    mixer = Mixer(code)
    mixer.count(every.where(~apart))
    if apart.any():
        mixer.learn(every.where(apart))
    before = mixer.table()
    mixer.count(every.where(apart))
    return before, mixer.table()


def _tokens(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and hash of every token, ends included, and whether it is the first of its text."""
    n = len(found.hashes) + found.rows
    is_end = np.zeros(n, bool)
    is_end[found.first[1:] + np.arange(found.rows)] = True
    hashes = np.full(n, END)
    hashes[~is_end] = found.hashes
    start = np.ones(n, bool)
    start[1:] = is_end[:-1]
    return np.repeat(np.arange(found.rows), found.counts + 1), hashes, start


def _grams(hashes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each token with the one, and with the two tokens before it."""

    def back(x):
        return np.where(start, START, np.concatenate([[START], x[:-1]]))

    before = back(hashes)
    second = back(before)
    pair = mix(mix(before + np.uint64(1)) + hashes)
    return pair, mix(mix(mix(second + np.uint64(2)) + before) + hashes)


def _coded(counts: np.ndarray) -> bytes:
    """A byte for each count, and eight more for those of 255 and above."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _decoded(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=n)
    return counts


@dataclass
class Names:
    """How pairs and triples are known: by the leading ``bits`` of their hashes, the first ``lead`` of which are the
    bucket's number. A chunk's are in order, so their gaps are sent, ``width`` bytes each; larger ones have a list."""

    lead: int
    bits: int
    width: int

    @staticmethod
    def of(tokens: int) -> Names:
        """For a corpus of about so many tokens. Gaps of a chunk's mostly leave three bits free."""
        in_chunk = int(2 * CHUNK // 6).bit_length()
        width = 3
        while 2 * tokens * COLLISION > 1 << (in_chunk + 8 * width - 3) and in_chunk + 8 * width - 3 < 58:
            width += 1
        lead = min(24, max(1, (2 * tokens // BUCKET).bit_length()))
        return Names(lead, in_chunk + 8 * width - 3, width)

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def bounds(self, ids: np.ndarray, bits: int) -> np.ndarray:
        """Where each bucket begins among sorted names of so many bits, and their end."""
        buckets = np.arange(1, 1 << self.lead).astype(np.uint64)
        return np.concatenate([[0], np.searchsorted(ids >> np.uint64(bits - self.lead), buckets), [len(ids)]])

    def base(self, bucket: int) -> np.uint64:
        return np.uint64(bucket << (self.bits - self.lead))

    def packed(self, ids: np.ndarray, bucket: int) -> bytes:
        gaps = np.diff(ids, prepend=self.base(bucket))
        over = np.flatnonzero(gaps >> np.uint64(8 * self.width))
        low = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width]
        far = (gaps[over] >> np.uint64(8 * self.width)).astype("<u8")
        return np.int64(len(over)).tobytes() + over.astype("<i8").tobytes() + far.tobytes() + low.tobytes()

    def unpacked(self, data: bytes, bucket: int) -> np.ndarray:
        n = int(np.frombuffer(data, "<i8", 1)[0])
        over, far = np.frombuffer(data, "<i8", n, 8), np.frombuffer(data, "<u8", n, 8 + 8 * n)
        low = np.frombuffer(data, np.uint8, offset=8 + 16 * n).reshape(-1, self.width)
        gaps = np.zeros((len(low), 8), np.uint8)
        gaps[:, : self.width] = low
        gaps = gaps.reshape(-1).view("<u8")
        gaps[over] += far << np.uint64(8 * self.width)
        return np.cumsum(gaps) + self.base(bucket)


HELD_OUT, APART, OTHERS = 0, 1, 2  # groups of chunks


class Chunk:
    """The tokens of a chunk of texts: all of one group, in the order of their ids and text hashes, so that the chunk
    asks the same whenever it is made anew."""

    def __init__(self, rows: pa.Table, names: Names, code: Code | None = None, table: Table | None = None):
        self.rows = rows.sort_by([("doc_id", "ascending"), ("th", "ascending")]).combine_chunks()
        self.names, self.n, self.trained = names, rows.num_rows, rows["grp"][0].as_py() != HELD_OUT
        held, before = [], 0
        for batch in self.rows.to_batches():
            for part, texts in chunks(batch):
                found = words(texts)
                owner, hashes, start = _tokens(found)
                pair, triple = _grams(hashes, start)
                own = [owner + before, hashes, names.cut(pair), names.cut(triple), start]
                before += part.num_rows
                if table is None:
                    shape = np.zeros(len(hashes), np.uint16)
                    shape[hashes != END] = shapes(found)[found.hashes != END]
                    own.append(shape)
                else:
                    e = events(code, found)
                    shared = (e.classes >= SINGLES) & ~e.repeats
                    own += [table.gain(e) - np.where(shared, code.log_class[e.classes], 0), shared]
                held.append(own)
        self.owner, self.hashes, self.pairs, self.triples, self.start, *rest = (
            np.concatenate(x) for x in zip(*held, strict=True)
        )
        if table is None:
            (self.shapes,) = rest
        else:
            self.logs, self.shared = rest

    def questions(self):
        """(bucket, words, their shapes and counts in training texts, pairs and triples, their counts): each word, pair
        and triple once."""
        found, first, word_c = np.unique(self.hashes, return_index=True, return_counts=True)
        grams, gram_c = np.unique(np.concatenate([self.pairs, self.triples]), return_counts=True)
        if not self.trained:
            word_c, gram_c = np.zeros(len(found), np.int64), np.zeros(len(grams), np.int64)
        word_at, gram_at = self.names.bounds(found, 64), self.names.bounds(grams, self.names.bits)
        for k in np.flatnonzero(np.diff(word_at) + np.diff(gram_at)).tolist():
            w, g = slice(word_at[k], word_at[k + 1]), slice(gram_at[k], gram_at[k + 1])
            own = (found[w].tobytes(), self.shapes[first[w]].tobytes(), _coded(word_c[w]))
            yield k, *own, self.names.packed(grams[g], k), _coded(gram_c[g])

    def answer(self, replies: pa.Table) -> None:
        """Takes the counts of all training texts from ``replies`` (bucket, words, grams), less each text's own."""
        found, word = np.unique(self.hashes, return_inverse=True)
        grams, gram = np.unique(np.concatenate([self.pairs, self.triples]), return_inverse=True)
        word_c, gram_c = np.zeros(len(found), np.int64), np.zeros(len(grams), np.int64)
        word_at, gram_at = self.names.bounds(found, 64), self.names.bounds(grams, self.names.bits)
        for k, of_words, of_grams in zip(*(replies[c].to_pylist() for c in ("bucket", "words", "grams")), strict=True):
            word_c[word_at[k] : word_at[k + 1]] = _decoded(of_words, word_at[k + 1] - word_at[k])
            gram_c[gram_at[k] : gram_at[k + 1]] = _decoded(of_grams, gram_at[k + 1] - gram_at[k])
        n = len(self.hashes)
        self.count, self.pair, self.triple = word_c[word], gram_c[gram[:n]], gram_c[gram[n:]]
        self.others = self.count
        if self.trained:
            # A text that has a word once has no pair that ends with it twice, and no triple twice whose pair it has once.
            own = self._own(word, np.arange(n))
            self.others = self.count - own
            for counts, of in ((self.pair, gram[:n]), (self.triple, gram[n:])):
                own = np.where(own > 1, 0, own)
                more = np.flatnonzero(own == 0)
                own[more] = self._own(of, more)
                counts -= own
        ends = np.append(np.flatnonzero(self.start)[1:], n) - 1
        texts_seen = self.others[ends][self.owner]  # as often as there are ends
        self.one = np.where(self.start, texts_seen, np.concatenate([[0], self.others[:-1]]))
        # Every pair but one that ends a text is the context of one triple.
        self.two = np.where(self.start, texts_seen, np.concatenate([[0], self.pair[:-1]]))
        self.level = _level(self.one) * LEVELS + _level(self.two)

    def _own(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the text of each of the tokens ``at`` has its number among them."""
        names = self.owner[at].astype(np.int64) << 32 | numbers[at]
        _, inverse, c = np.unique(names, return_inverse=True, return_counts=True)
        return c[inverse]

    def base(self, counts) -> np.ndarray:
        """Predictions by the tables, the words' shares of their classes by ``counts``."""
        return 10 ** (self.logs + np.where(self.shared, np.log10(counts + SMOOTH), 0))

    def sums(self, values) -> np.ndarray:
        return np.bincount(self.owner, values, minlength=self.n)


_CHUNK = ["grp", "chunk"]
_ASKED = "bucket int, grp int, chunk int, words binary, shapes binary, word_c binary, grams binary, gram_c binary"
_REPLIES = "bucket int, grp int, chunk int, words binary, grams binary, shapes binary, word_c binary"
VOCABULARY = -1  # the group of a bucket's own row


def _ask(names: Names):
    """A row per bucket with what the chunk asks of it."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        bucket, *parts = zip(*Chunk(t, names).questions(), strict=True)
        where = [pa.array([k.as_py()] * len(bucket), pa.int32()) for k in key]
        return pa.table(
            [pa.array(bucket, pa.int32()), *where, *(pa.array(x, pa.binary()) for x in parts)],
            names=["bucket", "grp", "chunk", "words", "shapes", "word_c", "grams", "gram_c"],
        )

    return run


def _totals(names: list[np.ndarray], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Distinct names, the place of one of each, their counts summed, and these for each list in its own order."""
    sizes = [len(x) for x in names]
    given = np.concatenate([_decoded(c, n) for c, n in zip(counts, sizes, strict=True)])
    found, first, inverse = np.unique(np.concatenate(names), return_index=True, return_inverse=True)
    total = np.bincount(inverse, given, len(found)).astype(np.int64)
    return found, first, total, [_coded(x) for x in np.split(total[inverse], np.cumsum(sizes)[:-1])]


def _reply(names: Names):
    """A bucket's questions are its counts: it sums them and sends each chunk the sums in the order of its question, and
    one row more with its part of the vocabulary."""

    def run(t: pa.Table) -> pa.Table:
        parts = {c: t[c].to_pylist() for c in ("bucket", "words", "shapes", "word_c", "grams", "gram_c")}
        found, first, total, words_ = _totals([np.frombuffer(x, np.uint64) for x in parts["words"]], parts["word_c"])
        asked = [names.unpacked(x, k) for x, k in zip(parts["grams"], parts["bucket"], strict=True)]
        *_, grams = _totals(asked, parts["gram_c"])
        shape = np.concatenate([np.frombuffer(x, np.uint16) for x in parts["shapes"]])
        known = total > 0
        own = (found[known].tobytes(), None, shape[first[known]].tobytes(), total[known].tobytes())
        nothing = [None] * t.num_rows
        columns = [
            [*parts["bucket"], parts["bucket"][0]],
            [*t["grp"].to_pylist(), VOCABULARY],
            [*t["chunk"].to_pylist(), 0],
            *([*x, last] for x, last in zip((words_, grams, nothing, nothing), own, strict=True)),
        ]
        kinds = [pa.int32()] * 3 + [pa.binary()] * 4
        return pa.table(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            names=["bucket", "grp", "chunk", "words", "grams", "shapes", "word_c"],
        )

    return run


def _vocabulary(batches):
    """(h, shape, c) of the buckets' own rows."""
    for batch in batches:
        for h, shape, c in zip(*(batch[k].to_pylist() for k in ("words", "shapes", "word_c")), strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(h, np.int64)),
                    pa.array(np.frombuffer(shape, np.uint16).astype(np.int32)),
                    pa.array(np.frombuffer(c, np.int64)),
                ],
                ["h", "shape", "c"],
            )


def _level(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64) + (n > 0), LEVELS - 1)


def _mixed(p, c, n, gate) -> np.ndarray:
    """Predictions mixed with the shares c / n; a context that was not seen leaves them."""
    gate = np.where(n > 0, gate, 0)
    return (1 - gate) * p + gate * c / np.maximum(n, 1)


def _answered(docs: DataFrame, replies: DataFrame, run, schema: str) -> DataFrame:
    """``run`` of every chunk with its replies."""
    return docs.groupBy(*_CHUNK).cogroup(replies.groupBy(*_CHUNK)).applyInArrow(lambda key, t, r: run(t, r), schema)


def _ratios(model, names: Names, gates):
    """(bin, c): how often a share c / n was how much larger than the prediction so far, by levels."""

    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        code, apart, _ = model.value
        a = Chunk(t, names, code, apart)
        a.answer(replies)
        p, c, n = a.base(a.others), a.pair, a.one
        if gates is not None:
            p, c, n = _mixed(p, c, n, gates[a.level]), a.triple, a.two
        ratio = np.log2(np.maximum(c, 1) / np.maximum(n, 1) / p)
        bins = np.where(c > 0, np.clip(np.rint(2 * ratio) + BINS // 2, 1, BINS - 1), 0).astype(np.int64)
        bins, counts = np.unique((a.level * BINS + bins)[n > 0], return_counts=True)
        return pa.table({"bin": pa.array(bins, pa.int64()), "c": pa.array(counts, pa.int64())})

    return run


def likeliest_shares(held: np.ndarray) -> np.ndarray:
    """For each level the share that makes its tokens likeliest; ``held`` counts them by level and ratio."""
    held = held.reshape(LEVELS * LEVELS, BINS)
    ratio = 2 ** ((np.arange(BINS) - BINS // 2) / 2)
    ratio[0] = 0
    share, seen = np.full((len(held), 1), 0.5), held.sum(axis=1, keepdims=True)
    for _ in range(200):
        share = (held * (share * ratio / (share * ratio + 1 - share))).sum(axis=1, keepdims=True) / np.maximum(seen, 1)
        share = np.clip(share, 0, 0.999)
    return share[:, 0]


def _gates(docs: DataFrame, replies: DataFrame, model, names: Names, gates=None) -> np.ndarray:
    """The likeliest share of the pairs, or with their ``gates`` of the triples, for each level."""
    only = F.col("grp") == APART
    found = _answered(docs.where(only), replies.where(only), _ratios(model, names, gates), "bin bigint, c bigint")
    held = np.zeros(LEVELS * LEVELS * BINS)
    for r in found.groupBy("bin").agg(F.sum("c").alias("c")).collect():  # LEVELS * LEVELS * BINS at most
        held[r["bin"]] = r["c"]
    return likeliest_shares(held)


def _score(model, names: Names, pairs, triples):
    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        code, _, table = model.value
        a = Chunk(t, names, code, table)
        a.answer(replies)
        p = _mixed(a.base(a.count), a.pair, a.one, pairs[a.level])
        p = _mixed(p, a.triple, a.two, triples[a.level])
        return a.rows.select(["doc_id", "grp", "n_bytes"]).add_column(
            3, "n_tokens", pa.array(a.sums(np.ones(len(a.owner))).astype(np.int64))
        ).add_column(4, "n_known", pa.array(a.sums(a.count > 0).astype(np.int64))).add_column(
            5, "base", pa.array(a.sums(np.log10(a.count + SMOOTH)))
        ).add_column(6, "score", pa.array(a.sums(np.log10(p))))

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text, ...), learnt from those that are not held out.

    A null or empty text is one end. Rows stay rows, whatever their ids; a null id counts as the empty text
    and is held out. Without training rows every token is unknown. Extra columns are not read; an empty
    table gives no rows. Texts are dealt to chunks by id and text, so only rows that are equal in both share one
    in any case.
    """
    ship(docs.sparkSession)
    with shuffles_removed(docs.sparkSession):
        return _scored(docs)


def _scored(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    fold = F.crc32(id_text.cast("binary")) % FOLDS
    group = F.when(fold == 0, HELD_OUT).when(fold == MIXER_FOLD, APART).otherwise(OTHERS).alias("grp")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    slim = docs.select("doc_id", group, n_bytes, F.xxhash64("text").alias("th"), "text")
    size = slim.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    names = Names.of(size.b // 6 + size.n)
    many = -(-(size.b + 8 * size.n) // CHUNK) + 1
    number = F.xxhash64("doc_id", "th")
    few = F.pmod(number, F.lit(-(-many // FOLDS)))
    dealt = slim.withColumn("chunk", F.when(F.col("grp") == OTHERS, F.pmod(number, F.lit(many))).otherwise(few).cast("int"))

    asked = dealt.groupBy(*_CHUNK).applyInArrow(_ask(names), _ASKED)
    replies = materialise(asked.groupBy("bucket").applyInArrow(_reply(names), _REPLIES), "replies")
    own = replies.where(F.col("grp") == VOCABULARY).select("words", "shapes", "word_c")
    code = make_code(materialise(own.mapInArrow(_vocabulary, "h bigint, shape int, c bigint"), "vocabulary"))
    replies = replies.where(F.col("grp") != VOCABULARY).drop("shapes", "word_c")

    known = spark.sparkContext.broadcast(code)  # SINGLES words and the code
    training = slim.where(F.col("grp") != HELD_OUT).select("grp", "text")
    observed = training.mapInArrow(_observations(known), "key bigint, c bigint")
    observed = observed.groupBy("key").agg(F.sum("c").alias("c"))
    context = F.pmod(F.shiftright("key", 4), F.lit(CONTEXTS)).cast("int").alias("both")
    sums = observed.groupBy(context).applyInArrow(_expanded(known), _SUMS)
    model = spark.sparkContext.broadcast((code, *train(code, sums)))  # a number per class and context
    release()

    pairs = _gates(dealt, replies, model, names)
    triples = _gates(dealt, replies, model, names, pairs)
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, grp int, n_bytes bigint, n_tokens bigint, n_known bigint, base double, score double"
    out = _answered(dealt, replies, _score(model, names, pairs, triples), schema)
    whole = float(np.log10(code.tokens + SMOOTH * (code.distinct + 1)))
    score = F.col("score")
    return out.select(
        "doc_id",
        (F.col("grp") == HELD_OUT).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(code.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        score,
        (-score * F.lit(float(np.log2(10))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
