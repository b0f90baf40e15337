"""Prefix trie of conversations, with totals of every subtree by centroid decomposition.

A node is a distinct sequence of first turns. It is named by the exclusive or of two 64-bit hashes
of its turns, each hashed together with its depth: names are running totals along a conversation
(``running``), so a conversation of any length spreads over tasks. Equal names of different
sequences have a chance of ``n**2 / 2**129`` among ``n`` nodes. Afterwards a node is the pair of its
smallest conversation (its owner) and its depth, and a conversation's *chain* is the path of its nodes.

``rollup`` totals values over subtrees. The parent edges form a component. Its centroid is the
deepest node whose part of the component is more than half of it; the nodes from there to the top
are those of which this is true. The total of what hangs below the centroid, itself included, is
added along that path; then the centroid is taken out, its children become tops of components, and
the rest goes on with smaller sizes. Components at least halve, so a path of a million turns takes
as few rounds as a bush. Components of more than ``limit`` nodes are split by Spark, all of them at
once a round; their centroids are few (nodes / limit) and are broadcast. The others are dealt
to tasks, each whole, and finished there by the same steps.

Cases: a null role or text is empty. Rows without a ``conv_id`` belong to no conversation. Turns of
equal number follow a hash of their role and text. Repeated rows are turns of their own. Long texts
are hashed, never moved. An empty table has no conversation and gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import EMPTY_SHA256, stage
from docmart.operators.running import Total, running
from docmart.operators.skew import of_counts, split_join

LIMIT = 4096  # nodes of a component that one task finishes
CENTROIDS = 10_000  # components larger than nodes / CENTROIDS are split by Spark, so at most as many at once


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, depth, h1, h2, n_bytes)``: turns numbered from 1, texts as hashes."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("h1"),
        F.xxhash64(F.lit("second"), *said).alias("h2"),
        F.octet_length(said[1]).cast("long").alias("n_bytes"),
    )
    order = [F.col("turn"), F.col("h1"), F.col("h2")]
    return running(rows, ["conv_id"], order, {"depth": Total("sum", F.lit(1).cast("long"))}).drop("turn")


def forked(numbered: DataFrame, every: int = 5, modulo: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: ``c`` gets the first ``h`` turns of conversation
    ``c - c % every`` and then its own after its first ``h``, where ``h = crc32(c) % modulo``.
    Returns the turns and ``(conv_id, length)`` of all conversations, those without a turn too."""
    numbered = stage(numbered, "turns")
    heads = numbered.where(F.col("depth") < modulo).groupBy("conv_id").agg(F.collect_list(F.struct("depth", "h1", "h2", "n_bytes")).alias("head"))
    heads = heads.select(F.col("conv_id").alias("base"), F.array_sort("head").alias("head"))
    convs = numbered.groupBy("conv_id").agg(F.max("depth").alias("n")).select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulo).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
    )
    known = convs.join(heads, "base", "left").select("conv_id", "n", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head"))
    known = stage(known.withColumn("kept", F.size("head").cast("long")), "forks")
    taken = known.select("conv_id", F.inline("head"))
    own = split_join(numbered, known.select("conv_id", "h", "kept"), ["conv_id"], of_counts(known, ["conv_id"], "n"), "inner")
    own = own.where("depth > h").select("conv_id", (F.col("depth") - F.col("h") + F.col("kept")).alias("depth"), "h1", "h2", "n_bytes")
    return taken.unionByName(own), known.select("conv_id", (F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def chains(turns_: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, depth, owner, n_convs, n_bytes, p_owner)`` of every conversation and depth, from 0
    (the textless root) on; ``p_owner`` is the owner of the node before."""
    tags = {"hi": F.xxhash64("depth", "h1", "h2"), "lo": F.xxhash64(F.lit("second"), "depth", "h2", "h1")}
    named = running(turns_.select("conv_id", "depth", "h1", "h2", "n_bytes"), ["conv_id"], [F.col("depth")], {k: Total("xor", v) for k, v in tags.items()})
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), zero.alias("n_bytes"))
    chain = stage(roots.unionByName(named.drop("h1", "h2")), "names")
    nodes = stage(chain.groupBy("hi", "lo", "depth").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")), "nodes")
    owned = split_join(chain, nodes, ["hi", "lo", "depth"], of_counts(nodes, ["hi", "lo", "depth"], "n_convs"), "inner").drop("hi", "lo")
    owned = stage(owned, "owners")
    before = owned.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("p_owner"))
    return stage(owned.join(before, ["conv_id", "depth"], "left"), "chains")


def _own() -> Column:
    return F.col("owner") == F.col("conv_id")


def sizes(chain: DataFrame) -> DataFrame:
    """``(owner, depth, size)``: nodes of each subtree. Every node counts along its owner's chain."""
    count = {"below": Total("sum", _own().cast("long"))}
    below = running(chain.select("conv_id", "depth", "owner"), ["conv_id"], [-F.col("depth")], count)
    return below.groupBy("owner", "depth").agg(F.sum("below").alias("size"))


# ---- centroid decomposition ----------------------------------------------------


def finish(parent: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of ``values`` (rows: kinds) in whole components. ``parent`` is an index, -1 for
    tops; ``size`` is each node's part of its component."""
    n = len(parent)
    own = np.arange(n)
    size, out = size.copy(), np.zeros_like(values)
    start, gone = parent < 0, np.zeros(n, bool)

    def tops() -> np.ndarray:
        up = np.where(start, own, parent)
        while True:
            further = up[up]
            if (further == up).all():
                return up
            up = further

    top = tops()
    while not gone.all():
        total = size[top]
        path = ~gone & (2 * size > total)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, top[path], size[path])
        centre = path & (size == least[top])
        start = start | centre | (np.where(parent >= 0, centre[parent], False))
        new = tops()
        below = ~gone & ((new != top) | centre)
        sums = np.zeros_like(values)
        for kind, row in enumerate(values):
            np.add.at(sums[kind], top[below], row[below])
        out[:, path] += sums[:, top[path]]
        size[path & ~centre] -= least[top[path & ~centre]]
        gone |= centre
        top = new
    return out


def _finish_all(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """``(owner, depth, kinds...)`` of components that tasks hold whole."""
    names = ["owner", "depth", "p_owner", "size", "t_owner", "t_depth", *kinds]
    flat = rows.select(*names).repartition("t_owner", "t_depth").sortWithinPartitions("t_owner", "t_depth", "depth")

    def settled(held: list[np.ndarray]) -> pa.RecordBatch:
        owner, depth, before, size, top_owner, top_depth, *values = held
        # Within a component: two may hold nodes of one conversation, but never the same node.
        names_, code = np.unique(np.concatenate((owner, before)), return_inverse=True)
        span = int(depth.max()) + 2
        node, up = code[: len(owner)] * span + depth, code[len(owner) :] * span + depth - 1
        order = np.argsort(node)
        at = np.minimum(np.searchsorted(node[order], up), len(node) - 1)
        top = (owner == top_owner) & (depth == top_depth)
        parent = np.where(top, -1, order[at])
        sums = finish(parent, size, np.stack(values))
        return pa.record_batch([pa.array(c) for c in (owner, depth, *sums)], names=["owner", "depth", *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        parts: list[list[np.ndarray]] = []

        def joined() -> list[np.ndarray]:
            return [np.concatenate(c) for c in zip(*parts, strict=True)]

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).fill_null(-1).to_numpy(zero_copy_only=False) for i in range(len(names))]
            owner, depth = columns[4], columns[5]
            cut = int(np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1]))))[-1])
            if parts and (cut or (parts[-1][4][-1], parts[-1][5][-1]) != (owner[0], depth[0])):
                # All but the last component of what is held is whole now.
                parts.append([c[:cut] for c in columns])
                held = joined()
                yield settled(held)
                parts = []
            elif cut:
                yield settled([c[:cut] for c in columns])
            parts.append([c[cut:] for c in columns])
        if parts:
            yield settled(joined())

    return flat.mapInArrow(run, ", ".join(["owner long", "depth long", *(f"{k} long" for k in kinds)]))


def rollup(chain: DataFrame, values: DataFrame, kinds: list[str], limit: int = LIMIT) -> DataFrame:
    """``(owner, depth, kinds...)``: for every node the totals of ``values`` ``(owner, depth, size,
    kinds...)`` over its subtree."""
    n = values.count()
    limit = max(limit, n // CENTROIDS)
    keys = ["owner", "depth"]
    flat = chain.select("conv_id", "depth", "owner", "p_owner", "n_convs")
    heavy = of_counts(flat.where(_own()), keys, "n_convs")
    zero = F.lit(0).cast("long")
    now = split_join(flat, values, keys, heavy, "inner").drop("n_convs")
    root = values.where("depth = 0").select("owner").first()
    if root is None:
        return values.select(*keys, *kinds)
    now = now.select("*", F.lit(root[0]).alias("t_owner"), zero.alias("t_depth"), F.lit(n).cast("long").alias("total"), *[zero.alias(f"acc_{k}") for k in kinds])
    now = stage(now, "forest")
    while True:
        large = now.where(_own() & (F.col("total") > limit))
        path = (F.col("total") > limit) & (2 * F.col("size") > F.col("total"))
        centres = large.where(path).groupBy("t_owner", "t_depth").agg(F.min_by(F.struct("owner", "depth", "size"), "size").alias("c"))
        found = centres.select("t_owner", "t_depth", F.col("c.owner").alias("c_owner"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")).collect()
        if not found:
            break
        few = now.sparkSession.createDataFrame(found, "t_owner long, t_depth long, c_owner long, c_depth long, c_size long")
        marked = now.join(F.broadcast(few), ["t_owner", "t_depth"], "left")
        is_c = F.coalesce((F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth")), F.lit(False))
        after_c = F.coalesce((F.col("p_owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth") + 1), F.lit(False))
        first = (F.col("t_owner") == F.col("owner")) & (F.col("t_depth") == F.col("depth"))
        marked = marked.select(
            *[c for c in now.columns if c not in ("t_owner", "t_depth", "total", "size")],
            F.col("t_owner").alias("o_owner"),
            F.col("t_depth").alias("o_depth"),
            path.alias("path"),
            is_c.alias("is_c"),
            F.when(path & ~is_c, F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size"),
            (F.coalesce(first, F.lit(False)) | after_c).alias("starts"),
        )
        here = F.struct("owner", "depth", F.col("size").alias("total"))
        moved = running(marked, ["conv_id"], [F.col("depth")], {"t": Total("last", F.when(F.col("starts"), here))})
        # A node taken out is in no component; one taken out in an earlier round stays so.
        out = F.col("is_c") | F.col("o_owner").isNull()
        moved = moved.select(
            *[c for c in moved.columns if c not in ("t", "starts")],
            F.when(~out, F.col("t.owner")).alias("t_owner"),
            F.when(~out, F.col("t.depth")).alias("t_depth"),
            F.when(~out, F.col("t.total")).alias("total"),
        )
        moved = stage(moved, "forest")
        left = F.col("is_c") | (F.col("t_owner") != F.col("o_owner")) | (F.col("t_depth") != F.col("o_depth"))
        sums = moved.where(_own() & left & F.col("o_owner").isNotNull()).groupBy("o_owner", "o_depth").agg(*[F.sum(k).alias(f"sum_{k}") for k in kinds])
        added = moved.join(F.broadcast(sums), ["o_owner", "o_depth"], "left")
        accs = {f"acc_{k}": F.col(f"acc_{k}") + F.coalesce(F.when(F.col("path"), F.col(f"sum_{k}")), zero) for k in kinds}
        now = stage(added.withColumns(accs).select(*now.columns), "forest")
    own = now.where(_own())
    rest = _finish_all(own.where(F.col("t_owner").isNotNull()), kinds)
    both = own.select(*keys, *[F.col(f"acc_{k}").alias(k) for k in kinds]).unionByName(rest)
    return both.groupBy(*keys).agg(*[F.sum(k).alias(k) for k in kinds])


# ---- nodes ----------------------------------------------------------------------


def _digests(ends: DataFrame) -> DataFrame:
    """``(owner, depth, sha256)`` of the ascending ids, comma-joined. Ranges of ids become pieces of
    text; only those meet at a node, and are hashed as they come."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, depth, conv = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1]), [True]))) if len(owner) else []
            text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            at = np.asarray(cuts[:-1], np.int64)
            yield pa.record_batch([pa.array(owner[at]), pa.array(depth[at]), pa.array(conv[at]), pa.array(text, pa.string())], names=["owner", "depth", "first", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple] = []
            for owner, depth, piece in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "piece")), strict=True):
                if (owner, depth) != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (owner, depth), hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield _hashed(done)
        if node:
            yield _hashed([(*node, state.hexdigest())])

    def _hashed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["owner", "depth", "sha256"])

    keys = ["owner", "depth"]
    ranged = ends.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    cut = ranged.mapInArrow(pieces, "owner long, depth long, first long, piece string")
    return cut.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(digest, "owner long, depth long, sha256 string")


def prefix_trie(turns_: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node: ``conv_id`` (its owner), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns_`` is ``(conv_id, depth, h1, h2, n_bytes)`` as of :func:`turns`, ``convs`` is ``(conv_id,
    length)`` and names every conversation. ``saved_tokens`` are the bytes of last texts that
    members share beyond the first, totalled over the subtree.
    """
    chain = chains(turns_, convs)
    own = chain.where(_own())
    keys = ["owner", "depth"]
    children = own.where("depth > 0").groupBy(F.col("p_owner").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = own.join(children, keys, "left").join(sizes(chain), keys).select(
        *keys,
        "p_owner",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "size",
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    nodes = stage(nodes, "trie")
    kinds = ["n_leaves", "saved_tokens"]
    totals = rollup(chain, nodes.select(*keys, "size", *kinds), kinds, limit)
    last = convs.select("conv_id", F.col("length").alias("depth"))
    ends = _digests(chain.join(last, ["conv_id", "depth"]))
    return (
        nodes.drop("size", *kinds)
        .join(totals, keys)
        .join(ends, keys, "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            F.col("p_owner").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
