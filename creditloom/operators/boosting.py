"""Gradient-boosted trees on binned rows (G6 to G9): Spark's algorithm, with a quarter of its memory and a fraction of its time.

Rows are binned and written once, in blocks, and kept as two bytes for every two features (with 204 bytes besides for a
row, Spark's trainer keeps four for each). Trees grow level by level: each task sums up weights, residuals and counts by
node and bin, where only the smaller child of a split is looked at, as the other one is what the parent has left. Two
features share a pass, since their bins make one number. The best splits are found on the driver, or, where sums are too
large for it, by node in a shuffle. Several fits can share the blocks, and a fit can go on from the trees of an earlier one.

The algorithm and its parameters are those of ``GBTClassifier``: candidate cuts from a sample of max(bins², 10,000) rows,
logistic loss, variance gain, leaves of mean residuals, rows drawn per tree and features per node. Draws differ from
Spark's, as they depend on seed, tree and block or node. The model is Spark's own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialise, shared_folder

BLOCK_ROWS = 65_536
TASK_ROWS = 2 * BLOCK_ROWS     # that a single task fits all trees on, as it would wait longer for others than it works
SAMPLE_ROWS = 10_000           # as Spark's trainer has it
DRIVER_BYTES = 64 << 20        # of a level's sums; beyond that nodes are shuffled
NODES_AT_ONCE = 16             # whose sums stay in a core's cache
ROUNDING = 1e-13               # a gain below this share of its terms is none


@dataclass(frozen=True)
class Binned:
    """Rows as blocks (number, codes of feature pairs, sign of the label, weight or None), cached, and the cuts behind the bins."""

    blocks: RDD
    cuts: list[np.ndarray]
    bits: int
    weighted: bool

    def close(self) -> None:
        self.blocks.unpersist()


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays; a leaf has left = -1. Rows whose bin is at most ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    stats: np.ndarray       # weight, weighted residual, its square, count


ROOT = Tree(*[np.array([n]) for n in (0, 0, -1, -1)], *[np.zeros(1)] * 2, np.zeros((1, 4)))


def find_cuts(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 cuts: between all neighbouring values if they are few, else at about equal weights."""
    found, place = np.unique(values, return_inverse=True)
    between = (found[:-1] + found[1:]) / 2
    if len(found) <= bins:
        return between
    held = np.cumsum(np.bincount(place, weights))
    stride = held[-1] / bins
    out, target, before = [], stride, float(held[0])
    for i, now in enumerate(held[1:].tolist()):
        if abs(before - target) < abs(now - target):
            out.append(i)
            target += stride
        before = now
    return between[out[:bins - 1]]


def _cells(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    found = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:width]]
    if any(np.isnan(c).any() for c in found):
        raise ValueError("Features must not be NULL or NaN")
    return found


def _coded(cells: Sequence[np.ndarray], cuts: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """One number for the bins of every two features, a line each."""
    out = np.zeros((-(-len(cuts) // 2), len(cells[0])), dtype=np.uint16)
    for f, cut in enumerate(cuts):
        out[f // 2] |= (np.searchsorted(cut, cells[f].astype(float)) << (0 if f % 2 else bits)).astype(np.uint16)
    return out


def bin_rows(df: DataFrame, bins: int, seed: int) -> Binned:
    """Bin the rows of ``df`` (features, then y: 0 or 1, and w: weight or NULL), write them in blocks and cache these."""
    spark, context, width = df.sparkSession, df.sparkSession.sparkContext, len(df.columns) - 2
    facts = df.agg(F.count(F.lit(1)).alias("rows"), F.count("w").alias("weighted"), F.min("w").alias("least"),
                   F.count_if(F.col("y").isin(0.0, 1.0)).alias("labelled"), F.count_if(F.isnan("w")).alias("nan")).first()
    rows, weighted = facts["rows"], facts["weighted"] > 0
    if not rows:
        raise ValueError("There are no rows to train on")
    if facts["labelled"] < rows:
        raise ValueError("Labels must be 0 or 1")
    if weighted and (facts["weighted"] < rows or facts["least"] < 0 or facts["nan"]):
        raise ValueError("Weights must be numbers of at least 0")
    bins = min(bins, rows)
    bits = max(1, math.ceil(math.log2(bins)))
    if bits > 8:
        raise ValueError("More than 256 bins aren't supported")
    share = min(1.0, max(bins * bins, SAMPLE_ROWS) / rows)
    seen = (df if share == 1.0 else df.sample(share, seed)).fillna(1.0, ["w"]).toArrow().combine_chunks().to_batches()
    if not seen:
        raise ValueError("There are no rows to find cuts on")
    w = seen[0].column(width + 1).to_numpy(zero_copy_only=False)
    cuts = [find_cuts(x.astype(float), w, bins) for x in _cells(seen[0], width)]
    parts = 1 if rows <= TASK_ROWS else max(context.defaultParallelism, -(-rows // (64 * BLOCK_ROWS)))
    most = min(BLOCK_ROWS, max(1024, rows // (4 * parts)))

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pa.RecordBatch:
            codes, y, w = (np.concatenate([h[i] for h in held], axis=-1) for i in range(3))
            return pa.RecordBatch.from_pydict({"number": [number], "size": [len(y)], "codes": [codes.tobytes()], "y": [y.tobytes()],
                                               "w": [w.tobytes() if weighted else None]}, schema)

        schema = pa.schema([("number", pa.int64()), ("size", pa.int64()), ("codes", pa.binary()), ("y", pa.binary()), ("w", pa.binary())])
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = _coded(_cells(batch, width), cuts, bits)
            y = np.where(batch.column(width).to_numpy(zero_copy_only=False) > 0, 1, -1).astype(np.int8)
            w, start = batch.column(width + 1).to_numpy(zero_copy_only=False), 0
            while start < len(y):
                end = min(len(y), start + most - size)
                held.append((codes[:, start:end], y[start:end], w[start:end]))
                size += end - start
                start = end
                if size == most:
                    yield block()
                    number, held, size = number + 1, [], 0
        if size:
            yield block()

    stored = materialise(df.mapInArrow(coded, "number long, size long, codes binary, y binary, w binary"), "binned")
    dealt = {r["number"]: i % parts for i, r in enumerate(stored.select("number").orderBy("number").collect())}
    lines = -(-width // 2)

    def settled(found: Iterable[tuple]) -> Iterator[tuple]:
        """Small blocks put together, in the order of their numbers."""
        held, size = [], 0
        for _, r in sorted(found, key=lambda x: x[1]["number"]):
            if held and size + r["size"] > BLOCK_ROWS:
                yield joined(held)
                held, size = [], 0
            held.append(r)
            size += r["size"]
        if held:
            yield joined(held)

    def joined(held: list) -> tuple:
        codes = np.concatenate([np.frombuffer(r["codes"], np.uint16).reshape(lines, r["size"]) for r in held], axis=1)
        return (held[0]["number"], codes, np.frombuffer(b"".join(r["y"] for r in held), np.int8),
                np.frombuffer(b"".join(r["w"] for r in held)) if weighted else None)

    blocks = _one_by_one(stored.rdd.map(lambda r: (dealt[r["number"]], r)).partitionBy(parts, lambda k: k).mapPartitions(settled))
    return Binned(blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER), cuts, bits, weighted)


def _one_by_one(rdd: RDD) -> RDD:
    """Blocks are passed on one at a time, so that two such tables can be zipped."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def rows_by_node(codes: np.ndarray, bits: int, tree: Tree, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows) for each leaf of the tree as far as it is grown."""
    todo = [(0, rows)]
    while todo:
        node, rows = todo.pop()
        if tree.left[node] < 0:
            yield node, rows
        elif len(rows):
            f = tree.feature[node]
            code = codes[f // 2].take(rows)
            left = (code & ((1 << bits) - 1) if f % 2 else code >> bits) <= tree.cut[node]
            todo += [(tree.left[node], rows[left]), (tree.right[node], rows[~left])]


def _residual(sign: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Negative gradient of 2 log(1 + exp(-2 sign margin)); the first tree is fitted on the labels themselves."""
    if margin is None:
        return sign.astype(float)
    with np.errstate(over="ignore"):
        return 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def node_sums(block: tuple, margin: np.ndarray | None, tree: Tree, wanted: Sequence[int], drawn: np.ndarray | None,
              bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block and each wanted node: (residual, count, weight if there is one) by feature and bin; and squares."""
    _, codes, sign, weight = block
    rows = np.arange(len(sign)) if drawn is None else np.flatnonzero(drawn)
    found = dict(rows_by_node(codes, bits, tree, rows))
    side, kinds = 1 << bits, 2 if weight is None else 3
    out, squares = np.zeros((len(wanted), kinds, width, side)), np.zeros(len(wanted))
    none = np.zeros(0, dtype=np.int64)
    for first in range(0, len(wanted), NODES_AT_ONCE):
        parts = [found.get(n, none) for n in wanted[first:first + NODES_AT_ONCE]]
        rows, nodes = np.concatenate(parts), len(parts)
        if not len(rows):
            continue
        whole = len(rows) == len(sign) and nodes == 1
        slot = np.repeat(np.arange(nodes), [len(p) for p in parts])
        place = slot << (2 * bits)
        w = None if weight is None else weight[rows]
        r = _residual(sign[rows], None if margin is None else margin[rows])
        wr = r if w is None else w * r
        squares[first:first + nodes] = np.bincount(slot, wr * r, nodes)
        for line in range(len(codes)):
            code = codes[line] if whole else codes[line].take(rows)
            at = place + code
            for kind, values in enumerate((wr, None, w)[:kinds]):
                both = np.bincount(at, values, nodes << (2 * bits)).reshape(nodes, side, side)
                out[first:first + nodes, kind, 2 * line] = both.sum(axis=2)
                if 2 * line + 1 < width:
                    out[first:first + nodes, kind, 2 * line + 1] = both.sum(axis=1)
    return out, squares


def best_split(sums: np.ndarray, among: np.ndarray, min_rows: int, min_gain: float) -> tuple | None:
    """(gain, feature, bin, sums left, sums right) of the highest variance gain; None if no split gains anything."""
    below = np.cumsum(sums[:, among], axis=2)
    total, left = below[:, 0, -1], below[:, :, :-1]
    right = total[:, None, None] - left
    weight = -1 if len(sums) == 3 else 1
    fine = (left[1] >= max(1, min_rows)) & (right[1] >= max(1, min_rows)) & (left[weight] > 0) & (right[weight] > 0)
    if not fine.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[0] ** 2 / left[weight] + right[0] ** 2 / right[weight] - total[0] ** 2 / total[weight]) / total[weight]
    gain = np.where(fine, gain, -np.inf)
    f, cut = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, cut] <= 0 or gain[f, cut] < min_gain:
        return None
    return float(gain[f, cut]), int(among[f]), int(cut), left[:, f, cut], right[:, f, cut]


def features_per_node(strategy: str, width: int) -> int:
    """How many features a node looks at, by the names Spark gives; of one tree, ``auto`` means all."""
    named = {"all": width, "auto": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))),
             "onethird": math.ceil(width / 3)}
    if strategy in named:
        return named[strategy]
    try:
        return min(width, int(strategy))
    except ValueError:
        return math.ceil(float(strategy) * width)


def _plus(block: tuple, margin: np.ndarray | None, bits: int, trees: Sequence[tuple[float, Tree]]) -> np.ndarray:
    """Margins of a block's rows after these trees as well."""
    out = np.zeros(len(block[2])) if margin is None else margin.copy()
    everyone = np.arange(len(out))
    for weight, tree in trees:
        for node, rows in rows_by_node(block[1], bits, tree, everyone):
            out[rows] += weight * tree.value[node]
    return out


@dataclass(frozen=True)
class Plan:
    """What a fit does, in plain numbers."""

    trees: int
    depth: int
    step: float
    share: float
    among: int
    min_rows: int
    min_gain: float
    seed: int
    bits: int
    width: int
    weighted: bool

    def weight(self, number: int) -> float:
        return self.step if number else 1.0

    def features(self, number: int, name: int) -> np.ndarray:
        """Those that a node of a tree looks at."""
        if self.among >= self.width:
            return np.arange(self.width)
        return np.sort(np.random.default_rng([self.seed, number, name]).choice(self.width, self.among, replace=False))

    def node_bytes(self) -> int:
        return self.width * (8 * (3 if self.weighted else 2) << self.bits)

    def sums(self, rows: Iterable[tuple], number: int, tree: Tree, wanted: Sequence[int]) -> tuple | None:
        """``node_sums`` of all blocks, over the rows drawn for this tree."""
        out = None
        for block, (margin, _) in rows:
            drawn = None
            if self.share < 1.0:
                drawn = np.random.default_rng([self.seed, number, block[0]]).random(len(block[2])) < self.share
            own = node_sums(block, margin, tree, wanted, drawn, self.bits, self.width)
            out = own if out is None else (out[0] + own[0], out[1] + own[1])
        return out


class Held:
    """Rows and margins in the memory of one task."""

    parts = 1

    def __init__(self, blocks: Iterable[tuple], plan: Plan, start: Sequence[Tree]):
        self.plan = plan
        known = [(plan.weight(i), t) for i, t in enumerate(start)]
        self.rows = [(b, (_plus(b, None, plan.bits, known) if known else None, None)) for b in blocks]

    def sums(self, number: int, tree: Tree, wanted: Sequence[int]) -> tuple:
        return self.plan.sums(self.rows, number, tree, wanted)

    def add(self, weight: float, tree: Tree, number: int) -> None:
        self.rows = [(b, (_plus(b, m, self.plan.bits, [(weight, tree)]), None)) for b, (m, _) in self.rows]


class Spread:
    """Rows and margins cached over the cluster; margins are written now and then, so that their lineage stays short.

    Whoever moves a block's margins on sums up the next tree's root as well, so the codes are read once for both.
    """

    def __init__(self, blocks: RDD, plan: Plan, start: Sequence[Tree], every: int):
        self.blocks, self.plan, self.every, self.kept, self.files = blocks, plan, every, [], []
        self.parts, self.rows = blocks.getNumPartitions(), blocks.map(lambda b: (b, (None, None)))
        if start:
            self._move([(plan.weight(i), t) for i, t in enumerate(start)], len(start), False)

    def _move(self, trees: Sequence[tuple[float, Tree]], number: int, write: bool) -> None:
        plan = self.plan

        def moved(row: tuple) -> tuple:
            block, (margin, _) = row
            margin = _plus(block, margin, plan.bits, trees)
            return margin, plan.sums([(block, (margin, None))], number, ROOT, [0])

        margins = _one_by_one(self.rows.map(moved)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
        if write:
            margins.checkpoint()
            self.files.append(margins)
        self.kept.append(margins)
        self.rows = self.blocks.zip(margins)

    def add(self, weight: float, tree: Tree, number: int) -> None:
        self._move([(weight, tree)], number + 1, self.every > 0 and (number + 1) % self.every == 0)

    def sums(self, number: int, tree: Tree, wanted: Sequence[int]) -> tuple:
        plan = self.plan

        def task(rows: Iterable[tuple]) -> Iterator[tuple]:
            found = plan.sums(rows, number, tree, wanted)
            if found is not None:
                yield found

        def roots(margins: Iterable[tuple]) -> Iterator[tuple]:
            found = [m[1] for m in margins]
            if found:
                yield sum(f[0] for f in found), sum(f[1] for f in found)

        first = len(tree.left) == 1 and self.kept
        found = (self.kept[-1].mapPartitions(roots) if first else self.rows.mapPartitions(task)).collect()
        self._forget(1)
        return sum(f[0] for f in found), sum(f[1] for f in found)

    def splits(self, number: int, tree: Tree, wanted: Sequence[int], names: dict[int, int]) -> dict[int, tuple]:
        """Best splits and totals of nodes whose sums are too many for the driver, each found where its sums meet."""
        out, plan, step = {}, self.plan, max(1, DRIVER_BYTES // self.plan.node_bytes())
        for first in range(0, len(wanted), step):
            some = wanted[first:first + step]

            def apart(part: int, rows: Iterable[tuple], some=some) -> Iterator[tuple]:
                found = plan.sums(rows, number, tree, some)
                if found is not None:
                    yield from ((node, (part, found[0][i], found[1][i])) for i, node in enumerate(some))

            def judged(item: tuple) -> tuple:
                node, found = item
                found = sorted(found, key=lambda x: x[0])
                return node, _judged(plan, number, names[node], sum(f[1] for f in found), sum(f[2] for f in found))

            out.update(self.rows.mapPartitionsWithIndex(apart).groupByKey(min(self.parts, len(some))).map(judged).collect())
        self._forget(1)
        return out

    def _forget(self, margins: int) -> None:
        """All but the last margins, and their files once a later one is written."""
        while len(self.kept) > margins:
            self.kept.pop(0).unpersist()
        while len(self.files) > margins and (not margins or self.files[-1].isCheckpointed()):
            if path := self.files.pop(0).getCheckpointFile():
                context = SparkContext._active_spark_context
                found = context._jvm.org.apache.hadoop.fs.Path(path)
                found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)

    def close(self) -> None:
        self._forget(0)


def _judged(plan: Plan, number: int, name: int, sums: np.ndarray, squares: float) -> tuple:
    """(best split or None, totals, squares) of a node."""
    total = sums[:, 0].sum(axis=1)
    split = best_split(sums, plan.features(number, name), plan.min_rows, plan.min_gain)
    if split is not None and split[0] <= ROUNDING * max(squares, 0.0) / total[-1 if len(total) == 3 else 1]:
        split = None
    return split, total, squares


def grow(source: Held | Spread, plan: Plan, number: int) -> Tree:
    """One more tree on the residuals that the source's margins leave."""
    lists = {n: [] for n in ("feature", "cut", "left", "right", "gain")}
    stats, names = [], {}

    def node(name: int) -> int:
        for column, empty in zip(lists.values(), (0, 0, -1, -1, 0.0)):
            column.append(empty)
        stats.append(np.zeros(4))
        names[len(stats) - 1] = name
        return len(stats) - 1

    def tree() -> Tree:
        table = np.array(stats)
        value = np.divide(table[:, 1], table[:, 0], out=np.zeros(len(table)), where=table[:, 0] > 0)
        return Tree(*[np.array(lists[n]) for n in ("feature", "cut", "left", "right")], value, np.array(lists["gain"]), table)

    def told(n: int, total: np.ndarray, squares: float) -> None:
        stats[n][:] = total[-1], total[0], max(0.0, squares), total[1]

    held: dict[int, tuple] = {}                           # sums and squares of the nodes that were split last
    level = [(node(1), None, None)]
    for _ in range(max(1, plan.depth)):
        now = tree()
        look = [n for n, parent, other in level
                if parent not in held or (stats[n][3], n) < (stats[other][3], other)]
        if len(look) * plan.node_bytes() * source.parts > DRIVER_BYTES and source.parts > 1:
            held, judged = {}, source.splits(number, now, [n for n, *_ in level], names)
        else:
            sums, squares = source.sums(number, now, look)
            fresh = {n: (sums[i], squares[i]) for i, n in enumerate(look)}
            for n, parent, other in level:
                if n not in fresh:
                    rest = held[parent][0] - fresh[other][0]
                    fresh[n] = np.where(rest[1] > 0, rest, 0.0), held[parent][1] - fresh[other][1]   # no rows, no rounding left
            held = fresh
            judged = {n: _judged(plan, number, names[n], *x) for n, x in fresh.items()}
        following = []
        for n, *_ in level:
            split, total, squares = judged[n]
            told(n, total, squares)
            if split is None or not plan.depth:
                continue
            lists["gain"][n], lists["feature"][n], lists["cut"][n] = split[:3]
            pair = lists["left"][n], lists["right"][n] = [node(2 * names[n]), node(2 * names[n] + 1)]
            for child, own in zip(pair, split[3:]):
                told(child, own, 0.0)
            following += [(pair[0], n, pair[1]), (pair[1], n, pair[0])]
        level = following
        if not level:
            break
    return tree()


def boost(source: Held | Spread, plan: Plan, start: Sequence[Tree]) -> Iterator[Tree]:
    """The trees that come after ``start``, one after the other."""
    for number in range(len(start), plan.trees):
        tree = grow(source, plan, number)
        if number + 1 < plan.trees:
            source.add(plan.weight(number), tree, number)
        yield tree


def boosted(binned: Binned, plan: Plan, start: Sequence[Tree], every: int) -> Iterator[Tree]:
    """As ``boost``, in one task if there are few rows."""
    if binned.blocks.getNumPartitions() == 1:
        yield from binned.blocks.mapPartitions(lambda blocks: boost(Held(blocks, plan, start), plan, start)).collect()
        return
    source = Spread(binned.blocks, plan, start, every)
    try:
        yield from boost(source, plan, start)
    finally:
        source.close()


def spark_tree(tree: Tree, cuts: Sequence[np.ndarray], uid: str):
    """The tree as Spark's own regression tree (a Java object). Leaves of the last level have no squares, so no impurity."""
    jvm = SparkContext._active_spark_context._jvm
    ml, doubles = jvm.org.apache.spark.ml, tree.stats[:, :3].astype(">f8")
    leaf, inner, between = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    calculator, part = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, jvm.java.util.Arrays.copyOfRange
    every = SparkContext._active_spark_context._gateway.new_array(jvm.double, doubles.size)
    jvm.java.nio.ByteBuffer.wrap(doubles.tobytes()).asDoubleBuffer().get(every)
    made: dict[int, object] = {}
    for n in reversed(range(len(tree.left))):             # children come after their parents
        weight, total, squares, count = tree.stats[n].tolist()
        stats, value = calculator(part(every, 3 * n, 3 * n + 3), int(count)), float(tree.value[n])
        impurity = max(0.0, squares - total * value) / weight if weight else 0.0
        if tree.left[n] < 0:
            made[n] = leaf(value, impurity, stats)
        else:
            f = int(tree.feature[n])
            made[n] = inner(value, impurity, float(tree.gain[n]), made.pop(int(tree.left[n])), made.pop(int(tree.right[n])),
                            between(f, float(cuts[f][tree.cut[n]])), stats)
    return ml.regression.DecisionTreeRegressionModel(uid, made[0], len(cuts))


class BoostedTrees(GBTClassifier):
    """Spark's boosted classifier, with its parameters and its model, fitted on binned rows."""

    binned: Binned | None = None
    start: Sequence[Tree] = ()
    grown: Sequence[Tree] = ()
    columns: Sequence[str] = ()

    def of(self, columns: Sequence[str]) -> BoostedTrees:
        """Read features from these columns, which the vector column was assembled from; that is faster."""
        self.columns = list(columns)
        return self

    def on(self, binned: Binned, start: Sequence[Tree] = ()) -> BoostedTrees:
        """Fit on these rows, whatever ``fit`` is given, and go on from these first trees of the same parameters."""
        self.binned, self.start = binned, start
        return self

    def bin(self, df: DataFrame) -> Binned:
        cells = [F.col(c) for c in self.columns]
        if not cells:
            vector = vector_to_array(self.getFeaturesCol())
            width = (df.select(F.size(vector)).first() or [0])[0]
            cells = [F.get(vector, F.lit(i)) for i in range(width)]
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(None).cast("double")
        return bin_rows(df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(cells)],
                                  F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w")),
                        self.getMaxBins(), self.getSeed())

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        context = dataset.sparkSession.sparkContext
        folder = shared_folder(dataset.sparkSession)      # where margins are written now and then
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        binned = self.binned or self.bin(dataset)
        width = len(binned.cuts)
        plan = Plan(self.getMaxIter(), self.getMaxDepth(), self.getStepSize(), self.getSubsamplingRate(),
                    features_per_node(self.getFeatureSubsetStrategy(), width), self.getMinInstancesPerNode(),
                    self.getMinInfoGain(), self.getSeed() % (1 << 63), binned.bits, width, binned.weighted)
        jvm, grown = context._jvm, list(self.start)
        with ThreadPoolExecutor(1) as pool:               # trees are handed to Java while the next ones grow
            made = [pool.submit(spark_tree, t, binned.cuts, f"{self.uid}-{i}") for i, t in enumerate(grown)]
            try:
                for tree in boosted(binned, plan, self.start, self.getCheckpointInterval()):
                    made.append(pool.submit(spark_tree, tree, binned.cuts, f"{self.uid}-{len(grown)}"))
                    grown.append(tree)
            finally:
                if self.binned is None:
                    binned.close()
        self.grown = grown
        trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(grown))
        weights = context._gateway.new_array(jvm.double, len(grown))
        for i, tree in enumerate(made):
            trees[i], weights[i] = tree.result(), plan.weight(i)
        model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(self.uid, trees, weights, width, 2)
        return self._copyValues(GBTClassificationModel(model))
