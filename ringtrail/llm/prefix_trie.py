"""Conversations as a prefix trie, with totals of every subtree by centroid decomposition.

A node is a distinct sequence of first turns. It is named by its depth and the least conversation
that begins with it, its owner: the owner's own turns then tell all ancestors of the node.

Totals of subtrees don't climb the trie depth by depth. The forest below the root is cut at
centroids instead: a component loses the node below which at least half of its weight lies, the
deepest such, and falls apart into parts of half its weight at most, which are cut in turn. The
weight of a node is its number of conversations, as the weight below it is then known beforehand:
it is the turns that its conversations have from there on. What lies below a centroid in its
component is added to every node from the centroid up to the component's top. A node and one of its
descendants are parted by one centroid on the way between them, so each is counted once.

Components of more than `at_once` weight are cut by Spark, all of one level together; there are
log2(turns / at_once) levels at most, however deep the trie is. Smaller ones have at most that many
nodes, and a task cuts them to the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringtrail.llm.rows import release, scratch, staged

#: Weight of a component that a task takes apart by itself, and ids joined to one text.
AT_ONCE, IDS = 50_000, 10_000
#: Turns that a conversation may take over from another.
MOST_GIVEN = 5

NOTHING = hashlib.sha256().hexdigest()
_LONG = "decimal(38,0)"


def slim_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest (of role and text), size (code points of the text)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(F.sha2(both, 256), 1, 32).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )


def placed_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as `part, k, conv_id, digest, size`, and chunks as `conv_id, part, first, before, n`.

    Turns are sorted by ranges, so a conversation of any length is spread over tasks; a chunk is
    what one range has of it. A turn's place in its conversation is `before + k - first`, and `n` is
    the number of all its turns. Both are staged.
    """
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "row"]
    with_row = turns.withColumn("row", F.monotonically_increasing_id())
    k = F.monotonically_increasing_id()
    sorted_turns = staged(
        with_row.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.shiftright(k, 33).alias("part"), k.alias("k"), "conv_id", "digest", "size"),
        "turns",
    )
    chunks = sorted_turns.groupBy("conv_id", "part").agg(
        F.min("k").alias("first"), F.count("*").alias("here")
    )
    # A conversation has no more chunks than there are ranges.
    own = Window.partitionBy("conv_id")
    so_far = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(
        "conv_id",
        "part",
        "first",
        F.coalesce(F.sum("here").over(so_far), F.lit(0).cast("long")).alias("before"),
        F.sum("here").over(own).alias("n"),
    )
    return sorted_turns, staged(chunks, "chunks")


def branched(turns: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another, as `paths` and `ends`.

    Conversation c takes over the first h = crc32(c) % 6 turns of conversation c - c % 100 (all if it
    has fewer, none if there is none) and goes on with its own turns after its first h.

    Paths: conv_id, part, depth (from 1), digest, size, total (turns it has now). Ends: conv_id,
    total of every conversation, turnless ones too.
    """
    convs = chunks.where("before = 0").select("conv_id", "n")
    convs = convs.select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % 100).alias("base"),
    )
    lengths = convs.where("base = conv_id").select("base", F.col("n").alias("n_base"))
    given = F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    convs = convs.join(lengths, "base", "left").withColumn("given", given)
    total = F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = staged(convs.select("conv_id", "base", "h", "given", total.alias("total")), "convs")

    own = turns.join(chunks.join(convs, "conv_id"), ["conv_id", "part"])
    own = own.withColumn("place", F.col("before") + F.col("k") - F.col("first"))
    kept = own.where("place >= h").select(
        "conv_id",
        "part",
        (F.col("place") - F.col("h") + F.col("given") + 1).alias("depth"),
        "digest",
        "size",
        "total",
    )
    # At most five turns of a conversation and a hundred that take them over (199 around zero).
    heads = own.where((F.col("conv_id") == F.col("base")) & (F.col("place") < MOST_GIVEN)).select(
        "base", F.col("place"), "digest", "size"
    )
    taken = convs.join(heads, "base").where("place < given").select(
        "conv_id",
        F.lit(-1).cast("long").alias("part"),
        (F.col("place") + 1).alias("depth"),
        "digest",
        "size",
        "total",
    )
    paths = staged(kept.unionByName(taken), "paths")
    return paths, convs.select("conv_id", "total")


def _named(paths: DataFrame) -> DataFrame:
    """conv_id, depth, owner and what is known of that node, for every turn of every path; staged.

    Sequences are compared by the sum of digests of their turns with depth, 120 bits. Sums add up
    over the chunks of a conversation, so no task needs all of it.
    """
    mark = F.sha2(F.concat("digest", F.lit(":"), F.col("depth").cast("string")), 256)
    chunk = Window.partitionBy("conv_id", "part")
    up_to = chunk.orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = {
        name: F.conv(F.substring(mark, at, 15), 16, 10).cast(_LONG)
        for name, at in (("a", 1), ("b", 16))
    }
    local = staged(
        paths.withColumns({name: F.sum(value).over(up_to) for name, value in own.items()}), "sums"
    )
    ends = local.groupBy("conv_id", "part").agg(
        *[F.max_by(name, "depth").alias(name) for name in "ab"]
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(
        "conv_id", "part", *[F.sum(name).over(earlier).alias(f"{name}0") for name in "ab"]
    ).where("a0 is not null")
    keys = local.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id",
        "depth",
        "size",
        "total",
        *[
            ((F.col(name) + F.coalesce(f"{name}0", F.lit(0))) % F.lit(1 << 60)).cast("long").alias(name)
            for name in "ab"
        ],
    )
    keys = staged(keys, "keys")
    release(local)
    nodes = keys.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("owner"),
        F.count("*").alias("n_convs"),
        F.max("size").alias("size"),
        F.sum(F.col("total") - F.col("depth") + 1).alias("below"),
        F.count_if(F.col("depth") == F.col("total")).alias("n_ends"),
    )
    found = keys.join(nodes.withColumnRenamed("size", "text_size"), ["depth", "a", "b"]).select(
        "conv_id", "depth", "total", "owner", "n_convs", F.col("text_size").alias("size"), "below", "n_ends"
    )
    named = staged(found, "named")
    release(keys)
    return named


def _forest(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, and for every owner the nodes on its path: conv_id, depth, owner, `next` (the
    owner one deeper); both staged."""
    owners = named.where("conv_id = owner").select("conv_id").distinct()
    lines = named.join(owners, "conv_id", "left_semi").select("conv_id", "depth", "owner")
    deeper = lines.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("owner").alias("next"))
    lines = staged(lines.join(deeper, ["conv_id", "depth"], "left"), "lines")
    parent = lines.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    top = lines.where("depth = 1").select("conv_id", F.col("owner").alias("top"))
    nodes = (
        named.where("conv_id = owner")
        .join(parent, ["conv_id", "depth"], "left")
        .join(top, "conv_id")
        .select(
            "owner",
            "depth",
            "parent",
            "n_convs",
            "n_ends",
            "below",
            "top",
            F.lit(1).cast("long").alias("top_depth"),
            (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
            F.lit(0).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
        )
    )
    return staged(nodes, "nodes"), lines


_COMPONENT = ["top", "top_depth"]


def _cut_level(nodes: DataFrame, lines: DataFrame, at_once: int) -> tuple[DataFrame, DataFrame, bool]:
    """Cut every component of more than `at_once` weight once.

    Gives nodes that are finished (centroids, and all nodes of small components, the latter to be
    finished by a task: `small`), the nodes of the parts, and whether there are any.
    """
    weights = staged(nodes.groupBy(*_COMPONENT).agg(F.sum("n_convs").alias("weight")), "weights")
    large = weights.where(F.col("weight") > at_once)
    if large.isEmpty():
        return nodes.withColumn("small", F.lit(True)), nodes.limit(0), False
    small = nodes.join(large, _COMPONENT, "left_anti").withColumn("small", F.lit(True))

    # Only a centroid and what is above it have half of the weight below them: disjoint subtrees
    # can't both, as the top has weight too. So they are one path, and the deepest is the centroid.
    heavy = F.col("below") * 2 >= F.col("weight")
    inside = nodes.join(large, _COMPONENT).withColumn("above", heavy).drop("weight")
    centroids = inside.where("above").groupBy(*_COMPONENT).agg(
        F.max_by(F.struct("owner", "depth", "below"), "depth").alias("x")
    )
    centroids = staged(
        centroids.select(
            *_COMPONENT,
            F.col("x.owner").alias("x_owner"),
            F.col("x.depth").alias("x_depth"),
            F.col("x.below").alias("x_below"),
        ),
        "centroids",
    )
    line = lines.select(
        F.col("conv_id").alias("owner"),
        F.col("depth").alias("x_depth"),
        F.col("owner").alias("there"),
        "next",
    )
    marked = (
        inside.join(centroids, _COMPONENT)
        .join(line, ["owner", "x_depth"], "left")
        .withColumn("under", F.coalesce(F.col("there") == F.col("x_owner"), F.lit(False)) & (F.col("depth") >= F.col("x_depth")))
        .drop("there")
    )
    marked = staged(marked, "marked")
    totals = marked.where("under").groupBy(*_COMPONENT).agg(
        F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved")
    )
    is_x = (F.col("owner") == F.col("x_owner")) & (F.col("depth") == F.col("x_depth"))
    under = F.col("under") & ~is_x

    def added(name: str, total: str) -> Column:
        return F.col(name) + F.when(F.col("above"), F.col(total)).otherwise(0)

    parts = marked.join(totals, _COMPONENT).select(
        "owner",
        "depth",
        "parent",
        "n_convs",
        "n_ends",
        (F.col("below") - F.when(F.col("above") & ~is_x, F.col("x_below")).otherwise(0)).alias("below"),
        F.when(under, F.col("next")).otherwise(F.col("top")).alias("top"),
        F.when(under, F.col("x_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
        "leaf",
        "saved",
        added("n_leaves", "t_leaf").alias("n_leaves"),
        added("saved_tokens", "t_saved").alias("saved_tokens"),
        is_x.alias("cut"),
    )
    parts = staged(parts, "parts")
    done = parts.where("cut").drop("cut").withColumn("small", F.lit(False))
    return small.unionByName(done), parts.where("not cut").drop("cut"), True


def centroid_totals(
    parents: list[int], weights: list[int], below: list[int], values: list[tuple[int, ...]]
) -> list[list[int]]:
    """Totals below every node of a forest, whose nodes come with parents first (-1: a top).

    `below` is the weight below a node within its tree, itself included.
    """
    below = list(below)
    width = len(values[0]) if values else 0
    found = [[0] * width for _ in parents]
    part_of: list[int] = []
    parts: dict[int, list[int]] = {}
    for node, parent in enumerate(parents):
        part_of.append(node if parent < 0 else part_of[parent])
        parts.setdefault(part_of[node], []).append(node)
    waiting = list(parts.values())
    while waiting:
        part = waiting.pop()
        half = sum(weights[v] for v in part)
        path = [v for v in part if 2 * below[v] >= half]
        x = path[-1]
        total, pieces, piece_of = list(values[x]), {}, {}
        for v in part:
            if v == x:
                continue
            parent = parents[v]
            piece = v if parent == x else piece_of.get(parent, -1)
            piece_of[v] = piece
            pieces.setdefault(piece, []).append(v)
            if piece >= 0:
                total = [a + b for a, b in zip(total, values[v])]
        for v in path:
            found[v] = [a + b for a, b in zip(found[v], total)]
            below[v] -= below[x] if v != x else 0
        waiting.extend(pieces.values())
    return found


_KEPT = ["owner", "depth", "parent", "n_convs", "n_ends", "n_leaves", "saved_tokens"]
_KINDS = ", ".join(f"{name} long" for name in _KEPT)


def _finish(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, sorted by component and depth: add what lies below each node."""

    def finished(table: pa.Table) -> pa.RecordBatch:
        column = {name: table.column(name).to_pylist() for name in table.column_names}
        at, parents = {}, []
        for i, key in enumerate(zip(column["top"], column["top_depth"], column["depth"], column["owner"])):
            top, top_depth, depth, _ = key
            at[key] = i
            above = (top, top_depth, depth - 1, column["parent"][i])
            parents.append(at[above] if depth > top_depth else -1)
        sums = centroid_totals(
            parents, column["n_convs"], column["below"], list(zip(column["leaf"], column["saved"]))
        )
        for name, part in (("n_leaves", 0), ("saved_tokens", 1)):
            column[name] = [a + s[part] for a, s in zip(column[name], sums)]
        return pa.RecordBatch.from_arrays([pa.array(column[n], pa.int64()) for n in _KEPT], _KEPT)

    waiting = None
    for batch in source:
        table = pa.Table.from_batches([batch])
        waiting = table if waiting is None else pa.concat_tables([waiting, table])
        # The last component may go on in the next batch.
        tops, depths = waiting.column("top").to_numpy(), waiting.column("top_depth").to_numpy()
        whole = int(((tops != tops[-1]) | (depths != depths[-1])).sum()) if len(tops) else 0
        if whole:
            yield finished(waiting.slice(0, whole))
            waiting = waiting.slice(whole).combine_chunks()
    if waiting is not None and waiting.num_rows:
        yield finished(waiting)


def _totals(nodes: DataFrame, lines: DataFrame, at_once: int) -> DataFrame:
    """All nodes with the totals of their subtrees."""
    finished, rest, more = _cut_level(nodes, lines, at_once)
    while more:
        done, rest, more = _cut_level(rest, lines, at_once)
        finished = finished.unionByName(done)
    by_part = (
        finished.where("small")
        .drop("small")
        .repartition(*_COMPONENT)
        .sortWithinPartitions(*_COMPONENT, "depth", "owner")
    )
    return finished.where("not small").select(*_KEPT).unionByName(by_part.mapInArrow(_finish, _KINDS))


def _joined(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each node, `IDS` at most in a text."""
    node, ids = None, []

    def text() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"owner": node[0], "depth": node[1], "first": ids[0], "ids": ",".join(map(str, ids))}],
            pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]),
        )

    for batch in source:
        for owner, depth, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if ids and ((owner, depth) != node or len(ids) == IDS):
                yield text()
                ids = []
            node = owner, depth
            ids.append(conv)
    if ids:
        yield text()


def _hashed(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node over its texts, which come in order; only a digest's state is held."""
    node, state = None, None
    done: dict[str, list] = {"owner": [], "depth": [], "ends_sha256": []}

    def close() -> None:
        if node is not None:
            for name, value in zip(done, (*node, state.hexdigest())):
                done[name].append(value)

    for batch in source:
        for owner, depth, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (owner, depth) == node:
                state.update(b",")
            else:
                close()
                node, state = (owner, depth), hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_pydict(done, pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]))
        for values in done.values():
            values.clear()
    close()
    yield pa.RecordBatch.from_pydict(done, pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())]))


def _end_digests(ends: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 from owner, depth, conv_id. Ids are sorted by ranges and joined to
    texts first, so the ids of a node that very many share are not sorted by one task."""
    key = ["owner", "depth", "conv_id"]
    texts = ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(
        _joined, "owner long, depth long, first long, ids string"
    )
    by_node = texts.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return by_node.mapInArrow(_hashed, "owner long, depth long, ends_sha256 string")


def trie(paths: DataFrame, ends: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """One row per node, the textless root too: conv_id (its least conversation), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `paths` has conv_id, part, depth, digest, size, total per turn, `part` growing with the depth of a
    conversation's turns; `ends` has conv_id and total of every conversation. No conversations give
    no rows.
    """
    least, count, turnless = ends.agg(
        F.min("conv_id"), F.count("*"), F.count_if(F.col("total") == 0)
    ).first()
    named = _named(paths)
    nodes, lines = _forest(named)
    totals = staged(_totals(nodes, lines, at_once), "totals")
    children = totals.where("depth > 1").groupBy(
        F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    own_ends = named.where("depth = total").select("owner", "depth", "conv_id")
    root = F.lit(least).cast("long")
    root_ends = ends.where("total = 0").select(root.alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id")
    below = totals.where("depth = 1").agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    zero = F.lit(0).cast("long")
    top = below.where(F.lit(count) > 0).select(
        root.alias("owner"),
        zero.alias("depth"),
        F.lit(None).cast("long").alias("parent"),
        F.lit(count).cast("long").alias("n_convs"),
        F.lit(turnless).cast("long").alias("n_ends"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        "n_children",
    )
    inner = totals.join(children, ["owner", "depth"], "left").withColumn(
        "n_children", F.coalesce("n_children", zero)
    )
    every = inner.withColumn("parent", F.coalesce("parent", root)).unionByName(top)
    digests = _end_digests(own_ends.unionByName(root_ends))
    return every.join(digests, ["owner", "depth"], "left").select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def branched_trie(conversations: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """The trie (see `trie`) of conversations that begin with turns of others (see `branched`).

    Turns are ordered by `turn`, NULL first, and of the same number by role, then by a digest of the
    text. NULL role or text counts as empty, and repeated rows are turns of their own. Rows without
    conv_id belong to no conversation and are left out. Only conv_id, turn, role and text are read.
    """
    with scratch(conversations.sparkSession) as lasting:
        turns, chunks = placed_turns(slim_turns(conversations))
        paths, ends = branched(turns, chunks)
        found = staged(trie(paths, ends, at_once), "trie")
        lasting.append(found)
    return found
