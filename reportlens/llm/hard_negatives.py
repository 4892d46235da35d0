"""Hard negatives by inner product, through STR-packed R-trees.

1. Rows are laid out by sort-tile-recursive packing: Spark orders them by the coordinate that varies most and cuts the
   order into blocks; inside a block each further coordinate, by variance, sorts and tiles the slabs of the one before,
   down to leaves. A block is one row of a table: its vectors in leaf order. Anchors are packed in the same way.
2. A box gives an interval for each coordinate, and so an interval for the inner product with any anchor. Blocks and
   anchor blocks are paired by their boxes: a pair that cannot hold what any of its anchors looks for is never formed.
   Each pair is one small piece of work, so that no key and no label gathers rows.
3. In a pair, each anchor walks the block's tree with a best-first queue: boxes outside all its score windows, or
   strictly below the last of the ``k`` results that it has, are pruned. Equal scores go to the smaller id.
4. Each anchor first meets the one block that promises most. What it finds there bounds the other blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
BLOCK, ANCHORS, LEAF, FANOUT = 8192, 256, 512, 8
LARGEST = 1 << 27
_LOW, _HIGH = -(1 << 62), 1 << 62


def prepare(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of the rows that take part: those with a label and a
    vector whose components are all there and finite. Components become
    floor(scale * x), held to +-2^27 so that inner products of up to 128 stay
    exact; a null vec_id takes no part."""
    x = F.transform(F.col("embedding"), lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = F.transform(x, lambda e: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.lit(float(scale)) * e))).cast("int"))
    held = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    return held.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


# Sort-tile-recursive packing ----------------------------------------------------------------------------------------

def str_order(vectors, axes, leaf=LEAF):
    """Row numbers in the order of their leaves. With P leaves to fill and n
    axes left, a slab is cut into about P^(1/n) slabs by the next axis."""
    out, todo = [], [(np.arange(len(vectors)), 0)]
    while todo:
        ids, k = todo.pop()
        pages = -(-len(ids) // leaf)
        if pages <= 1 or k == len(axes):
            out.append(ids)
            continue
        ids = ids[np.argsort(vectors[ids, axes[k]], kind="stable")]
        slabs = max(2, round(pages ** (1 / min(len(axes) - k, max(1, np.log2(pages))))))
        size = -(-pages // slabs) * leaf
        todo += [(ids[i:i + size], k + 1) for i in range(0, len(ids), size)][::-1]
    return np.concatenate(out) if out else np.arange(0)


class RTree:
    """Boxes over vectors in leaf order: ``levels[0]`` the leaves, the last level the root's children."""

    def __init__(self, vectors, leaf=LEAF, fanout=FANOUT):
        self.vectors, self.leaf, self.fanout = vectors, leaf, fanout
        at = np.arange(0, len(vectors), leaf)
        boxes = (np.minimum.reduceat(vectors, at), np.maximum.reduceat(vectors, at))
        self.levels = [boxes]
        while len(boxes[0]) > fanout:
            at = np.arange(0, len(boxes[0]), fanout)
            boxes = (np.minimum.reduceat(boxes[0], at), np.maximum.reduceat(boxes[1], at))
            self.levels.append(boxes)

    def bounds(self, anchors):
        """Per level, the least and largest inner product of each anchor with anything in each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T) for lo, hi in self.levels]

    def search(self, anchor, bounds, allowed, ids, windows, k):
        """[(window, score, id)]: for each window (low, high) the ``k`` best
        scores inside it among ``allowed`` rows, from the best down.

        ``bounds``: this anchor's intervals per level. The queue is ordered by
        the largest score a box may hold.
        """
        found = [[] for _ in windows]  # heaps of (score, -id), the worst on top
        top = len(self.levels) - 1
        queue = [(-int(u), top, n) for n, u in enumerate(bounds[top][1])]
        heapq.heapify(queue)
        while queue:
            most, level, n = heapq.heappop(queue)
            most, least = -most, bounds[level][0][n]
            wanted = [w for w, (low, high) in enumerate(windows)
                      if most >= low and least <= high and (len(found[w]) < k or most >= found[w][0][0])]
            if not wanted:
                continue
            if level:
                a, b = n * self.fanout, min((n + 1) * self.fanout, len(bounds[level - 1][1]))
                for m in range(a, b):
                    heapq.heappush(queue, (-int(bounds[level - 1][1][m]), level - 1, m))
                continue
            a, b = n * self.leaf, min((n + 1) * self.leaf, len(self.vectors))
            score = self.vectors[a:b] @ anchor
            # What a window still takes: from its low or the last of its k results up to its high.
            floor = {w: max(windows[w][0], found[w][0][0]) if len(found[w]) == k else windows[w][0] for w in wanted}
            hits = np.flatnonzero(allowed[a:b] & (score >= min(floor.values())) & (score <= max(windows[w][1] for w in wanted)))
            if not len(hits):
                continue
            hits = hits[np.argsort(-score[hits], kind="stable")]
            values, named = score[hits].tolist(), ids[a + hits].tolist()
            for w in wanted:
                low, high, held = floor[w], windows[w][1], found[w]
                for s, i in zip(values, named):
                    if s > high:
                        continue
                    if s < low or len(held) == k and s < held[0][0]:
                        break
                    item = (int(s), -i)
                    if len(held) < k:
                        heapq.heappush(held, item)
                    elif item > held[0]:
                        heapq.heapreplace(held, item)
        return [(w, s, -i) for w, held in enumerate(found) for s, i in sorted(held, reverse=True)]


def _axes(rows: DataFrame) -> list[int]:
    """Coordinates by falling variance; one row per coordinate comes to the driver."""
    each = rows.select(F.posexplode("v").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("spread"))
    return [r.axis for r in each.orderBy(F.desc("spread"), "axis").collect()]


def _matrix(lists):
    """Rows of equal length; missing components are 0."""
    width = max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), max(width, 1)), np.int64)
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


_BLOCK = "block long, ids array<long>, labels array<long>, width long, vectors binary, lo array<long>, hi array<long>"


def _pack(size, axes):
    def pages(part, frames):
        n = 0
        held = None
        for f in frames:
            held = f if held is None else pd.concat([held, f])
            while len(held) >= 2 * size:
                yield one(part + n, held.iloc[:size])
                held, n = held.iloc[size:], n + 1
        if held is not None and len(held):
            for start in range(0, len(held), size):
                yield one(part + n, held.iloc[start:start + size])
                n += 1

    def one(name, f):
        v = _matrix(f["v"].tolist())
        order = str_order(v, [a for a in axes if a < v.shape[1]][1:])
        v = v[order]
        return pd.DataFrame({"block": [name], "ids": [f["vec_id"].to_numpy()[order]], "labels": [f["label"].to_numpy()[order]],
                             "width": [v.shape[1]], "vectors": [v.astype(np.int32).tobytes()], "lo": [v.min(axis=0)], "hi": [v.max(axis=0)]})

    def run(frames):
        from pyspark import TaskContext

        yield from pages(TaskContext.get().partitionId() << 32, frames)
    return run


def packed(rows: DataFrame, size: int, axes: list[int]) -> DataFrame:
    """``rows`` (vec_id, label, v) as blocks of at most ``size`` rows, written."""
    lead = F.coalesce(F.get("v", F.lit(axes[0] if axes else 0)), F.lit(0))
    dealt = rows.repartitionByRange(lead, "vec_id").sortWithinPartitions(lead, "vec_id")
    return cut_lineage(dealt.mapInPandas(_pack(size, axes), _BLOCK))


# Pairs of blocks ----------------------------------------------------------------------------------------------------

def _vectors(raw, width):
    return np.frombuffer(raw, np.int32).reshape(-1, width).astype(np.int64)


def _fit(a, b):
    """Both matrices with the columns of the wider one."""
    n = max(a.shape[1], b.shape[1])
    return [np.pad(x, ((0, 0), (0, n - x.shape[1]))) if x.shape[1] < n else x for x in (a, b)]


def _small(m):
    """Whether inner products stay below 2^52, so that floats, which multiply faster, are exact."""
    return m.shape[1] <= 1 << 12 and np.abs(m).max(initial=0) <= 1 << 20


def _meet(k, same):
    """Groups arrive as a block (role 0) and the anchor blocks it meets (role 1)."""
    def run(batches):
        ids = labels = vectors = tree = None
        for batch in batches:
            out = []
            for k_row in range(batch.num_rows):
                row = batch.slice(k_row, 1).to_pylist()[0]
                if row["role"] == 0:
                    ids, labels = np.array(row["ids"]), np.array(row["labels"])
                    vectors, tree = _vectors(row["vectors"], row["width"]), None
                    continue
                a_ids, a_labels = row["ids"], row["labels"]
                anchors, rows = _fit(_vectors(row["vectors"], row["width"]), vectors)
                kind = np.float64 if _small(anchors) and _small(rows) else np.int64
                if tree is None or tree.vectors.dtype != kind or tree.vectors.shape != rows.shape:
                    tree = RTree(rows.astype(kind))
                anchors = anchors.astype(kind)
                bounds = tree.bounds(anchors)
                for n, (anchor, label) in enumerate(zip(a_ids, a_labels)):
                    windows = [(w["low"], w["high"]) for w in row["windows"][n]] if row["windows"] else [(_LOW, _HIGH)]
                    allowed = (labels == label) & (ids != anchor) if same else labels != label
                    for w, score, vec in tree.search(anchors[n], [(lo[n], hi[n]) for lo, hi in bounds], allowed, ids, windows, k):
                        out.append((anchor, *windows[w], score, vec))
                if len(out) > 50000:
                    yield rows_of(out)
                    out = []
            yield rows_of(out)

    def rows_of(out):
        return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(5)],
                                          ["anchor_id", "low", "high", "score", "vec_id"])
    return run


def _bound(a_lo, a_hi, lo, hi, largest: bool):
    """The least or largest inner product of anything in the one box with anything in the other."""
    def corner(x):
        options = [x["p"] * x["r"], x["p"] * x["s"], x["q"] * x["r"], x["q"] * x["s"]]
        return F.greatest(*options) if largest else F.least(*options)
    # Where one vector is shorter, what is missing is 0.
    boxes = F.transform(F.arrays_zip(a_lo.alias("p"), a_hi.alias("q"), lo.alias("r"), hi.alias("s")),
                        lambda x: F.struct(*[F.coalesce(x[c], F.lit(0)).alias(c) for c in "pqrs"]))
    return F.aggregate(boxes, F.lit(0).cast("long"), lambda s, x: s + corner(x))


def _search(pairs: DataFrame, blocks: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """The best ``k`` of each anchor and window over ``pairs`` (block, group)."""
    pairs = cut_lineage(pairs)
    column = ["ids", "labels", "width", "vectors", "windows"]
    left = blocks.join(pairs.select("block").distinct(), "block").withColumn("windows", F.lit(None).cast(dict(anchors.dtypes)["windows"]))
    left = left.select("block", F.lit(0).alias("role"), F.lit(-1).cast("long").alias("group"), *column)
    right = pairs.select("block", "group").join(anchors, "group").select("block", F.lit(1).alias("role"), "group", *column)
    rows = left.unionByName(right).repartition("block").sortWithinPartitions("block", "role", "group")
    return rows.mapInArrow(_meet(k, same), "anchor_id long, low long, high long, score long, vec_id long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "low", "high").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top(blocks: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, low, high, score, vec_id, rank): the best ``k`` rows of each
    anchor and window. ``anchors``: group, lo, hi, ids, labels, width, vectors,
    windows per anchor."""
    boxes = blocks.select("block", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    asked = anchors.select("group", "lo", "hi", F.flatten("windows").alias("w"))
    asked = asked.withColumn("low", F.array_min("w.low")).withColumn("high", F.array_max("w.high")).drop("w")
    # The stated query set against all rows, in blocks.
    both = cut_lineage(asked.crossJoin(boxes).select(
        "group", "block", "low", "high", _bound(F.col("lo"), F.col("hi"), F.col("b_lo"), F.col("b_hi"), True).alias("most"),
        _bound(F.col("lo"), F.col("hi"), F.col("b_lo"), F.col("b_hi"), False).alias("least"))
        .where("most >= low and least <= high"))
    first = both.groupBy("group").agg(F.max_by("block", F.struct("most", -F.col("block"))).alias("block"))
    seen = cut_lineage(_search(first, blocks, anchors, k, same))
    # An anchor's window without k results yet leaves its group open.
    held = seen.groupBy("anchor_id", "low", "high").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    each = anchors.select("group", F.explode(F.arrays_zip("ids", "windows")).alias("a")).select(
        "group", F.col("a.ids").alias("anchor_id"), F.explode("a.windows").alias("w")).select("group", "anchor_id", "w.*")
    worst = each.join(held, ["anchor_id", "low", "high"], "left").groupBy("group").agg(
        F.min(F.when(F.col("n") >= k, F.col("kth")).otherwise(F.col("low"))).alias("worst"))
    left = both.join(worst, "group").where("most >= worst").join(first, ["group", "block"], "left_anti")
    return _best(seen.unionByName(_search(left, blocks, anchors, k, same)), k)


def hard_negatives(rows: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
                   every: int = 100, block: int = BLOCK, group: int = ANCHORS) -> DataFrame:
    """Negatives of ``rows`` (vec_id, label, v; see ``prepare``) just below each positive.

    Anchors are the rows whose id is divisible by ``every``. Per anchor, its
    ``n_positives`` best rows of the same label, itself left out; per positive,
    the ``n_negatives`` best rows of other labels that score ``low`` to ``high``
    percent of it. Returned: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. Missing components of shorter vectors count
    as 0. Rows that repeat an id, label and vector are one; ids are otherwise
    taken as unique. Equal scores rank by smaller id. An empty table gives an
    empty result.
    """
    rows = cut_lineage(rows.distinct())
    axes = _axes(rows)
    blocks = packed(rows, block, axes)
    window = "array<array<struct<low:long,high:long>>>"
    anchors = packed(rows.where(F.col("vec_id") % every == 0), group, axes).withColumnRenamed("block", "group")
    all_ = F.struct(F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high"))
    open_ = anchors.withColumn("windows", F.transform("ids", lambda _: F.array(all_)).cast(window))
    positives = cut_lineage(_top(blocks, open_, n_positives, True).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # Whole scores inside [low, high] percent of the positive one.
    positives = positives.withColumn("low", F.expr(f"({low} * positive_score + pmod(-{low} * positive_score, 100)) div 100"))
    positives = positives.withColumn("high", F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100"))
    positives = cut_lineage(positives)
    sought = positives.where("low <= high").groupBy("anchor_id").agg(F.collect_set(F.struct("low", "high")).alias("w"))
    places = anchors.select("group", F.posexplode("ids").alias("place", "anchor_id")).join(sought, "anchor_id", "left")
    windows = places.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("w", F.array().cast(
        "array<struct<low:long,high:long>>")).alias("w")))).alias("placed"))
    closed = cut_lineage(anchors.join(windows.select("group", F.col("placed.w").alias("windows")), "group"))
    negatives = _top(blocks, closed, n_negatives, False)
    return positives.join(negatives, ["anchor_id", "low", "high"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def shifted_labels(rows: DataFrame, divisor: int = 7, labels: int = 10) -> DataFrame:
    """``rows`` (vec_id, label, v) whose ids are divisible by ``divisor`` with the next label."""
    moved = F.when(F.col("vec_id") % divisor == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.withColumn("label", moved)
