"""The trie of conversations' turn prefixes, rolled up by centroid decomposition.

A node is a sequence of first turns.  Its key is the exclusive or of the
hashes of its (place, turn) pairs, so that keys of all prefixes are running
aggregates, whatever a conversation's length.  Subtree totals come from the
parent-edge forest: a component's centroid (the deepest node with half of the
component's weight below it) is cut out, the component's total at and below
it is added to every node on the path from it to the component's top, and
what is left falls apart into components of at most half the weight.  Large
components are split so by Spark, all of a round at once; those that fit a
task are split to the end inside tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from islet.llm.common import scalar, stage
from islet.operators.ordered import BLOCK_TARGET_ROWS, default_blocks

#: Member rows (one for each conversation and depth) of a component that a task splits.
LOCAL_ROWS = 1 << 14
TASK_NODES = 20_000
RUN = 1 << 16  # turns of a conversation, or ids of a node's ends, that one step takes


def numbered(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) -> (conv_id, i, digest, chars), i from 1
    by turn, null first; equal turns go by a digest of role and text.

    Rows without a conv_id are in no conversation; null role and text are
    empty; repeated rows are turns of their own.  Only digests and lengths are
    shuffled, in range blocks that part a long conversation too.
    """
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.filter(turns["conv_id"].isNotNull()).select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    n = max(default_blocks(rows), -(-rows.count() // BLOCK_TARGET_ROWS))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")]
    rows = stage(rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(n, *order).withColumn("block", F.spark_partition_id()), "turns")
    own = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order[1:]))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "block").count().withColumn("before", F.sum("count").over(earlier)).filter("before > 0").drop("count")
    # at most one conversation a block began in an earlier one
    rows = rows.withColumn("own", own).join(F.broadcast(before), ["conv_id", "block"], "left")
    return rows.select("conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).cast("long").alias("i"), "digest", "chars")


def rebuilt(turns: DataFrame, hundred: int = 100, most: int = 6) -> DataFrame:
    """Numbered turns -> rows (conv_id, depth, digest, chars, length) of the
    rebuilt conversations: the first h turns of conversation c - c % hundred,
    then c's own after its first h, where h = crc32(c) % most.  Each has a row
    of depth 0; length is its number of turns.  ids are whole numbers."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    turns = stage(turns, "numbered")
    convs = turns.groupBy("conv_id").agg(F.max("i").alias("n_own")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % hundred})
    convs = stage(convs, "convs")
    bases = convs.filter("conv_id = base").select("base", F.col("n_own").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = stage(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    own = turns.join(convs, "conv_id").filter("i > h").select("conv_id", (F.col("taken") + F.col("i") - F.col("h")).alias("depth"), "digest", "chars", "length")
    first = turns.filter((F.col("i") < most) & (F.col("conv_id") % hundred == 0)).select(F.col("conv_id").alias("base"), "i", "digest", "chars")
    shared = convs.filter("taken > 0").join(first, "base").filter("i <= taken").select("conv_id", F.col("i").alias("depth"), "digest", "chars", "length")
    top = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("chars"), "length")
    return top.unionByName(own).unionByName(shared)


def members(turns: DataFrame) -> DataFrame:
    """Rebuilt turns -> also the node (a, b) of the prefix that ends with each
    and its parent (pa, pb).  Long conversations are keyed run by run."""
    own = {"oa": F.when(F.col("depth") > 0, F.xxhash64("depth", "digest")).otherwise(0), "ob": F.when(F.col("depth") > 0, F.xxhash64("digest", "depth")).otherwise(0)}
    rows = stage(turns.withColumns(own).withColumn("run", F.floor(F.col("depth") / RUN)), "prefixes")
    within = Window.partitionBy("conv_id", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"a": F.bit_xor("oa").over(within), "b": F.bit_xor("ob").over(within)})
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.filter(F.col("length") >= RUN).groupBy("conv_id", "run").agg(F.bit_xor("oa").alias("ca"), F.bit_xor("ob").alias("cb"))
    sums = sums.withColumns({"ca": F.bit_xor("ca").over(earlier), "cb": F.bit_xor("cb").over(earlier)}).filter("run > 0")
    names = ["conv_id", "depth", "chars", "length", "oa", "ob", "a", "b"]
    far = rows.filter("run > 0").join(sums, ["conv_id", "run"]).withColumns({"a": F.col("a").bitwiseXOR(F.col("ca")), "b": F.col("b").bitwiseXOR(F.col("cb"))})
    rows = rows.filter("run = 0").select(*names).unionByName(far.select(*names))
    return rows.select("conv_id", "depth", "chars", "length", "a", "b", F.col("a").bitwiseXOR(F.col("oa")).alias("pa"), F.col("b").bitwiseXOR(F.col("ob")).alias("pb"))


def preorder(parent: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(nodes in preorder, last place of each place's subtree); tops have a
    parent below 0."""
    children: list[list[int]] = [[] for _ in parent]
    todo = []
    for i, p in enumerate(parent):
        (children[p] if p >= 0 else todo).append(i)
    order, place = [], [0] * len(parent)
    while todo:
        i = todo.pop()
        place[i] = len(order)
        order.append(i)
        todo += children[i]
    last = list(range(len(order)))
    for k in range(len(order) - 1, -1, -1):
        p = parent[order[k]]
        if p >= 0:
            last[place[p]] = max(last[place[p]], last[k])
    return np.array(order, np.int64), np.array(last, np.int64)


def rollup_forest(parent: list[int], values: np.ndarray) -> np.ndarray:
    """Subtree totals of each row of ``values`` by centroid decomposition of
    all trees at once; the weight of a component is its number of nodes."""
    n = len(parent)
    order, last = preorder(parent)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    above = np.array(parent, np.int64)[order]
    above = np.where(above >= 0, place[above], -1)
    value = values[order]
    found, out = np.zeros_like(value), np.zeros_like(value)
    weight = last - np.arange(n) + 1
    comp = np.maximum.accumulate(np.where(above < 0, np.arange(n), 0)) if n else above
    nodes = np.arange(n)
    while len(nodes):
        own = comp[nodes]
        total = np.zeros(n, np.int64)
        np.maximum.at(total, own, weight[nodes])
        path = 2 * weight[nodes] >= total[own]
        centre = np.full(n, -1, np.int64)
        np.maximum.at(centre, own[path], nodes[path])  # deepest of a chain, so the last in preorder
        c = centre[own]
        below = (nodes >= c) & (nodes <= last[c])
        sums = np.zeros_like(value)
        np.add.at(sums, own[below], value[nodes[below]])
        done = nodes == c
        out[nodes[done]] = found[nodes[done]] + sums[own[done]]
        up = path & ~done
        found[nodes[up]] += sums[own[up]]
        weight[nodes[up]] -= weight[c[up]]
        # a child of the centroid and all that follow it up to the next child are a component
        nodes, c, below = nodes[~done], c[~done], below[~done]
        by = np.lexsort((nodes, comp[nodes]))
        nodes, c, below = nodes[by], c[by], below[by]
        top = np.maximum.accumulate(np.where(below & (above[nodes] == c), np.arange(len(nodes)), -1)) if len(nodes) else nodes
        comp[nodes[below]] = nodes[top[below]]
    back = np.empty_like(out)
    back[order] = out
    return back


def _local(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Totals of whole components, many a task."""
    n = max(1, -(-nodes.count() // TASK_NODES))
    nodes = nodes.withColumn("task", F.pmod(F.xxhash64("ta", "tb"), F.lit(n)))
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in ("a", "b", *values)]])

    def totals(group: pa.Table) -> pa.Table:
        held = {c: group.column(c).to_numpy() for c in group.column_names}
        place = {k: i for i, k in enumerate(zip(held["a"].tolist(), held["b"].tolist()))}
        top = (held["a"] == held["ta"]) & (held["b"] == held["tb"])
        parent = [-1 if t else place[k] for t, k in zip(top.tolist(), zip(held["pa"].tolist(), held["pb"].tolist()))]
        sums = rollup_forest(parent, np.stack([held[v] for v in values], 1))
        return pa.table({"a": held["a"], "b": held["b"], **{v: sums[:, j] + held[f"found_{v}"] for j, v in enumerate(values)}})

    return nodes.groupBy("task").applyInArrow(totals, schema)


def rollup(nodes: DataFrame, paths: DataFrame, values: list[str], local_rows: int = LOCAL_ROWS) -> DataFrame:
    """nodes(a, b, pa, pb, depth, conv_id: one member, weight: member rows at
    and below, values..), paths(conv_id, depth, a, b, pa, pb) of all members
    -> (a, b, values: summed over subtrees).

    A round halves the weight of every component above ``local_rows``, so
    there are as many rounds as doublings.  A node tells which child of the
    centroid it is under by its member's prefix of that depth.
    """
    rest = nodes.select("a", "b", "pa", "pb", "depth", "conv_id", "weight", *values, F.lit(0).cast("long").alias("ta"), F.lit(0).cast("long").alias("tb"), *[F.lit(0).cast("long").alias(f"found_{v}") for v in values])
    names = rest.columns
    rest = stage(rest, "components")  # else the joins' keys are constants
    small, done = [], []
    while True:
        tops = stage(rest.groupBy("ta", "tb").agg(F.max("weight").alias("total")), "tops")
        large = tops.filter(F.col("total") > local_rows)
        small.append(rest.join(tops.filter(F.col("total") <= local_rows), ["ta", "tb"]).select(*names))
        if large.isEmpty():
            break
        rest = rest.join(large, ["ta", "tb"])
        halves = rest.filter(2 * F.col("weight") >= F.col("total"))
        centre = halves.groupBy("ta", "tb", "total").agg(F.max(F.struct("depth", "a", "b", "weight")).alias("c"))
        centre = stage(centre.select("ta", "tb", F.col("c.depth").alias("c_depth"), F.col("c.a").alias("ca"), F.col("c.b").alias("cb"), F.col("c.weight").alias("c_weight")), "centroids")
        rest = rest.join(centre, ["ta", "tb"])
        step = paths.select("conv_id", F.col("depth").alias("at"), F.col("a").alias("na"), F.col("b").alias("nb"), F.col("pa").alias("npa"), F.col("pb").alias("npb"))
        rest = rest.withColumn("at", F.col("c_depth") + 1)
        deep = rest.filter("depth > c_depth").join(step, ["conv_id", "at"])
        is_below = (F.col("npa") == F.col("ca")) & (F.col("npb") == F.col("cb"))
        deep = deep.withColumns({"na": F.when(is_below, F.col("na")), "nb": F.when(is_below, F.col("nb"))}).drop("npa", "npb")
        none = F.lit(None).cast("long")
        is_centre = (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb"))
        rest = deep.unionByName(rest.filter("depth <= c_depth").withColumns({"na": none, "nb": none}))
        rest = stage(rest.withColumns({"below": F.col("na").isNotNull() | is_centre, "path": (2 * F.col("weight") >= F.col("total")) & ~is_centre, "centre": is_centre}), "labelled")
        sums = stage(rest.filter("below").groupBy("ta", "tb").agg(*[F.sum(v).alias(f"sum_{v}") for v in values]), "sums")
        rest = rest.join(sums, ["ta", "tb"])
        done.append(rest.filter("centre").select("a", "b", *[(F.col(f"found_{v}") + F.col(f"sum_{v}")).alias(v) for v in values]))
        rest = rest.filter("not centre").withColumns({f"found_{v}": F.col(f"found_{v}") + F.when(F.col("path"), F.col(f"sum_{v}")).otherwise(0) for v in values})
        rest = rest.withColumn("weight", F.col("weight") - F.when(F.col("path"), F.col("c_weight")).otherwise(0))
        rest = rest.withColumns({"ta": F.coalesce("na", "ta"), "tb": F.coalesce("nb", "tb")})
        rest = stage(rest.select(*names), "components")
    out = _local(_union(small), values)
    return _union([out, *done])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ends_digest(ends: DataFrame) -> DataFrame:
    """ends(a, b, conv_id) -> (a, b, ends_sha256) of a node's ids in numeric
    order, by commas.  Range blocks join runs of ids; a task hashes a node's
    runs as they come, holding one."""
    n = max(default_blocks(ends), -(-ends.count() // BLOCK_TARGET_ROWS))
    ends = ends.select("a", "b", F.col("conv_id").alias("id")).repartitionByRange(n, "a", "b", "id").sortWithinPartitions("a", "b", "id").withColumn("block", F.spark_partition_id())
    runs_schema, out_schema = "a long, b long, block int, run long, ids string", "a long, b long, ends_sha256 string"

    def joined(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = 0
        for batch in it:
            for lo in range(0, batch.num_rows, RUN):
                part = batch.slice(lo, RUN)
                a, b = (part.column(c).to_numpy() for c in ("a", "b"))
                cuts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
                ids = part.column("id").cast(pa.string()).to_pylist()
                text = [",".join(ids[i:j]) for i, j in zip(cuts, [*cuts[1:], len(ids)])]
                yield pa.RecordBatch.from_arrays([pa.array(a[cuts]), pa.array(b[cuts]), part.column("block").take(pa.array(cuts)), pa.array(np.arange(k, k + len(cuts))), pa.array(text)], ["a", "b", "block", "run", "ids"])
                k += len(cuts)

    def hashed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in it:
            out = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256(ids.encode())
            yield _rows(out)
        if node is not None:
            yield _rows([(*node, state.hexdigest())])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["a", "b", "ends_sha256"])

    runs = ends.mapInArrow(joined, runs_schema)
    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "block", "run").mapInArrow(hashed, out_schema)


def trie(turns: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """Rebuilt turns (conv_id, depth, digest, chars, length) -> a row for each
    node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    The root has depth 0 and a null parent; without conversations there is no
    node.  Further columns of the input are not read.
    """
    paths = stage(members(turns), "members")
    weight = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    nodes = paths.groupBy("a", "b").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.max("chars").alias("chars"), F.count(F.lit(1)).alias("n_convs"), weight)
    nodes = stage(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    nodes = nodes.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = stage(nodes, "forest")
    totals = rollup(nodes, paths, ["n_leaves", "saved_tokens"], local_rows)
    ends = ends_digest(paths.filter("depth = length"))
    first = scalar(nodes.filter("depth = 0"), F.min("conv_id"))
    kind = nodes.schema["conv_id"].dataType
    above = nodes.filter("depth > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.drop("n_leaves", "saved_tokens")
    # the root is a parent that all depths below it share, so it comes as a value
    near = nodes.filter("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.lit(first)).cast(kind))
    nodes = near.unionByName(nodes.filter("depth > 1").join(above, ["pa", "pb"]))
    nodes = nodes.join(totals, ["a", "b"]).join(ends, ["a", "b"], "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
