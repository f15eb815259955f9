"""The prefix trie of conversations, built in batches with fat binary search.

A conversation is a sequence of turns. A prefix has a 122-bit name: the sum of digests of its turns and their places, so
names come from running sums and no conversation has to fit one task. Only the conversation with the smallest id of each
distinct sequence enters the trie; how many share the sequence is its weight.

The trie is compacted: its nodes are the places where sequences part or end. A node's edge is the range of depths from
its parent's depth (exclusive) to its own. In every such range one depth is two-fattest, divisible by the largest power of
two; the name of the prefix of that length is the node's handle. To find where a sequence leaves the trie, its depths are
halved at two-fattest ones: a join of prefix names with handles tells whether a node is there, which raises the lower bound
to the node's own depth, or lowers the upper one. That takes as many joins as the length has bits, for all sequences of a
batch at once. Then the batch is inserted: edges are cut where a sequence leaves them, and the rest of the batch, whose
prefixes no node has, adds its own nodes.

Sums over subtrees double their reach: a node adds what it has to the ancestor 1, 2, 4, ... nodes above. At last edges
are expanded into a row per depth.

For scale: rows are turns and nodes, never whole conversations. Conversations that a range boundary cuts are mended from
a table of one row per partition. The ids of a group of equal conversations are hashed as a stream of pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from vecferry.llm.common import WORD, written

GROUP = 20  # conversations that share the first turns of one
SHARED = 4  # fewer turns than that
BATCHES = 3
PIECE = 1 << 14  # ids of a group that are hashed at once
RUN = 1 << 12  # depths of an edge that are expanded together
MASK = (1 << 61) - 1

ROOT = b"\0" * 16
NODE = ["node", "top", "depth", "parent", "conv_id", "handle", "first"]


def _streamed(ordered: DataFrame, sums: list[str]) -> DataFrame:
    """Rows that come sorted within ranges of ``conv_id`` and more, with their number ``at`` in the conversation.

    ``sums`` become running sums (modulo 2 ** 61) in it. What a conversation had in the partitions before is added from a
    table with a row per partition.
    """
    keep = [c for c in ordered.columns if c not in sums]
    kinds = {f.name: f.dataType.simpleString() for f in ordered.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in keep] + [f"{c} long" for c in ["at", *sums]] + ["part int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, before = TaskContext.get().partitionId(), None, [np.uint64(0)] * (1 + len(sums))
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(conv))))
            made = []
            for i, values in enumerate([np.ones(len(conv), np.uint64), *[batch.column(c).to_numpy().view(np.uint64) for c in sums]]):
                total = np.cumsum(values)
                base = total[first] - values[first]
                if conv[0] == current:
                    base[0] -= before[i]
                made.append((total - base[of]) & np.uint64(MASK))
            current, before = conv[-1], [m[-1] for m in made]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(m.view(np.int64)) for m in made], pa.array(np.full(len(conv), part, np.int32))],
                names=[*keep, "at", *sums, "part"])

    names = ["at", *sums]
    rows = written(ordered.mapInArrow(run, schema), "streamed")
    ends = rows.groupBy("part").agg(
        F.min("conv_id").alias("first"), F.max_by(F.struct("conv_id", *names), F.struct("conv_id", "at")).alias("last")).orderBy("part").collect()
    behind, total = [], None  # a row per partition
    for end in ends:
        mine = [0] * len(names)
        if total and total[0] == end["first"]:
            mine = total[1]
            behind.append((end.part, end["first"], *mine))
        values = [end["last"][c] for c in names]
        through = end["first"] == end["last"].conv_id
        total = (end["last"].conv_id, [(v + m) & MASK for v, m in zip(values, mine, strict=True)] if through else values)
    if not behind:
        return rows.drop("part")
    table = rows.sparkSession.createDataFrame(behind, "_part int, _conv long, " + ", ".join(f"_{c} long" for c in names))
    met = rows.join(F.broadcast(table), (F.col("part") == F.col("_part")) & (F.col("conv_id") == F.col("_conv")), "left")
    return met.select(*keep, *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).bitwiseAND(MASK).alias(c) for c in names])


def _shared(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED).cast("long")


def _own_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, digest, n_words, at``: all turns in their order."""
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    content = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return _streamed(ordered.select(
        "conv_id", F.unhex(F.md5(content.cast("binary"))).alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words")), [])


def _rebuilt(own: DataFrame) -> DataFrame:
    """``conv_id, depth, digest, n_words``: first turns of the group's first conversation, then the own ones after as many."""
    first = own.filter((F.col("conv_id") % GROUP == 0) & (F.col("at") < SHARED)).select(
        F.col("conv_id").alias("of"), F.col("at").alias("depth"), "digest", "n_words")
    group = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("group")
    every = own.select("conv_id").distinct().select("conv_id", group, _shared(F.col("conv_id")).alias("shared"))
    taken = every.join(first, (F.col("group") == F.col("of")) & (F.col("depth") <= F.col("shared"))).select("conv_id", "depth", "digest", "n_words")
    lengths = first.groupBy("of").agg(F.max("depth").alias("length"))
    rest = own.withColumns({"group": group, "shared": _shared(F.col("conv_id"))}).filter("at > shared")
    rest = rest.join(lengths, F.col("group") == F.col("of"), "left")
    depth = F.least("shared", F.coalesce("length", F.lit(0))) + F.col("at") - F.col("shared")
    return taken.unionByName(rest.select("conv_id", depth.alias("depth"), "digest", "n_words"))


def _name(a: Column, b: Column) -> Column:
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """``conv_id, depth, n_words, words`` (of all turns so far), ``name`` and ``before``, the name without the last turn."""
    marks = [F.xxhash64(F.lit(side), "depth", "digest").bitwiseAND(MASK).alias(side) for side in ("a", "b")]
    ordered = rebuilt.select("conv_id", "depth", "n_words", *marks, F.col("a").alias("own_a"), F.col("b").alias("own_b"), F.col("n_words").alias("words"))
    ordered = ordered.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    sums = _streamed(ordered, ["a", "b", "words"])
    less = [(F.col(c) - F.col(f"own_{c}")).bitwiseAND(MASK) for c in ("a", "b")]
    return sums.select("conv_id", "depth", "n_words", "words", _name(F.col("a"), F.col("b")).alias("name"), _name(*less).alias("before"))


def _hashed_ids(members: DataFrame) -> DataFrame:
    """``name, sha256`` of the comma-joined ascending ``conv_id`` of each group ``name``, as a stream of pieces."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids, out = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), []
            at = 0
            while at < len(ids):
                end = at + 1
                while end < len(ids) and end - at < PIECE and names[end] == names[at]:
                    end += 1
                out.append((names[at], ids[at], ",".join(map(str, ids[at:end]))))
                at = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())],
                names=["name", "least", "piece"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None
        for batch in batches:
            done = []
            for name, piece in zip(batch.column("name").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if name == current:
                    sha.update(b"," + piece.encode())
                else:
                    if current is not None:
                        done.append((current, sha.hexdigest()))
                    current, sha = name, hashlib.sha256(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["name", "sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([sha.hexdigest()])], names=["name", "sha256"])

    ordered = members.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = written(ordered.mapInArrow(join, "name binary, least long, piece string"), "pieces")
    return pieces.repartition("name").sortWithinPartitions("name", "least").mapInArrow(digest, "name binary, sha256 string")


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the largest power of two divides: the leading bits that the two share, and one more."""
    return F.expr(f"{high} & ~(shiftleft(1L, length(bin({low} ^ {high})) - 1) - 1L)")


def _at_depth(table: DataFrame, paths: DataFrame, depth: str, found: str, kind: str = "inner") -> DataFrame:
    """The table with the name ``found`` of the prefix of its ``conv_id`` at ``depth``."""
    side = paths.select(F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth"), F.col("name").alias(found))
    return table.join(side, (F.col("conv_id") == F.col("_conv")) & (F.col(depth) == F.col("_depth")), kind).drop("_conv", "_depth")


def _nodes(table: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes ``node, top, depth, parent, conv_id`` with their handles and the names of the first prefix on their edges."""
    ready = table.withColumns({"_at": two_fattest("top", "depth"), "_begin": F.col("top") + 1})
    return _at_depth(_at_depth(ready, paths, "_at", "handle"), paths, "_begin", "first").select(*NODE)


def locate(batch: DataFrame, nodes: DataFrame, paths: DataFrame, steps: int) -> DataFrame:
    """``conv_id, length, exit, edge, top, end``: the depth at which each sequence leaves the trie.

    ``edge`` names the edge (from ``top`` to ``end``) that it leaves; it is null where the sequence leaves at a node.
    """
    handles = nodes.select("handle", F.col("node").alias("_node"), F.col("top").alias("_top"), F.col("depth").alias("_end"), F.col("conv_id").alias("_rep"))
    state = batch.select(
        "conv_id", "length", F.lit(0).cast("long").alias("low"), F.col("length").alias("high"), F.lit(ROOT).alias("node"),
        F.lit(0).cast("long").alias("top"), F.lit(0).cast("long").alias("end"), F.lit(None).cast("long").alias("rep"))
    done = []
    for step in range(steps):
        asked = _at_depth(state.withColumn("_f", two_fattest("low", "high")), paths, "_f", "_name")
        met = asked.join(handles, F.col("_name") == F.col("handle"), "left")
        hit = F.col("_node").isNotNull()
        state = written(met.select(
            "conv_id", "length", F.when(hit, F.col("_end")).otherwise(F.col("low")).alias("low"), F.when(hit, F.col("high")).otherwise(F.col("_f") - 1).alias("high"),
            *[F.when(hit, F.col(new)).otherwise(F.col(old)).alias(old) for old, new in (("node", "_node"), ("top", "_top"), ("end", "_end"), ("rep", "_rep"))]), "search")
        done.append(state.filter("low >= high"))
        state = state.filter("low < high")
        if step + 1 < steps and state.isEmpty():
            break
    last = _at_depth(reduce(DataFrame.unionByName, done), paths, "end", "_reached", "left")
    last = written(last.withColumn("through", F.coalesce(F.col("_reached") == F.col("node"), F.col("end") == 0)).drop("_reached"), "reached")
    # Where a sequence has gone through its last node, it may leave on the edge to a child.
    children = nodes.select(F.col("first").alias("_first"), F.col("node").alias("_node"), F.col("top").alias("_top"), F.col("depth").alias("_end"), F.col("conv_id").alias("_rep"))
    onward = _at_depth(last.filter("through").withColumn("_next", F.col("end") + 1), paths, "_next", "_name", "left")
    onward = onward.join(children, F.col("_name") == F.col("_first"), "left")
    onward = onward.select("conv_id", "length", F.col("_node").alias("edge"), F.col("_top").alias("top"), F.col("_end").alias("bottom"), F.col("_rep").alias("rep"), F.col("end").alias("at_node"))
    inside = last.filter("not through").select("conv_id", "length", F.col("node").alias("edge"), "top", F.col("end").alias("bottom"), "rep", F.lit(None).cast("long").alias("at_node"))
    edges = written(onward.unionByName(inside), "edges")
    # How far it follows that edge: depths at which its prefix is the one of the edge's conversation.
    left = edges.filter("edge is not null").join(paths.select(F.col("conv_id").alias("_conv"), "depth", "name"), F.col("conv_id") == F.col("_conv"))
    left = left.filter("depth > top and depth <= bottom").select("conv_id", "rep", "depth", "name")
    right = paths.select(F.col("conv_id").alias("_rep"), F.col("depth").alias("_depth"), F.col("name").alias("_same"))
    alike = left.join(right, (F.col("rep") == F.col("_rep")) & (F.col("depth") == F.col("_depth")) & (F.col("name") == F.col("_same")))
    far = alike.groupBy("conv_id").agg(F.max("depth").alias("exit"))
    return edges.join(far.withColumnRenamed("conv_id", "_of"), F.col("conv_id") == F.col("_of"), "left").select(
        "conv_id", "length", F.coalesce("exit", "at_node", "top").alias("exit"), "edge", "top", "bottom")


def insert(nodes: DataFrame, located: DataFrame, paths: DataFrame) -> DataFrame:
    """The trie with the located sequences in it."""
    # Edges that sequences leave between two nodes are cut there.
    cuts = _at_depth(located.filter("edge is not null and exit > top and exit < bottom"), paths, "exit", "name")
    cuts = cuts.select("edge", F.col("exit").alias("depth"), "name").distinct()
    old = nodes.select(*[F.col(c).alias(f"old_{c}") for c in NODE])
    cut = written(cuts.join(old, F.col("edge") == F.col("old_node")), "cuts")
    bottoms = nodes.join(cut.select("edge").distinct(), F.col("node") == F.col("edge"), "left_semi")
    places = cut.select("edge", "depth", "name", "old_top", "old_parent", "old_conv_id").unionByName(bottoms.select(
        F.col("node").alias("edge"), "depth", F.col("node").alias("name"), F.col("top").alias("old_top"), F.col("parent").alias("old_parent"), F.col("conv_id").alias("old_conv_id")))
    along = Window.partitionBy("edge").orderBy("depth")  # cuts of one edge: each is by a sequence that is longer than the last
    pieces = places.select(
        F.col("name").alias("node"), F.coalesce(F.lag("depth").over(along), "old_top").alias("top"), "depth",
        F.coalesce(F.lag("name").over(along), "old_parent").alias("parent"), F.col("old_conv_id").alias("conv_id"))
    # Prefixes that no node has. Of the sequences that share one, the smallest stands for it; its prefixes are a stretch of depths.
    fresh = paths.join(located.select(F.col("conv_id").alias("_conv"), "exit", "length"), F.col("conv_id") == F.col("_conv")).filter("depth > exit")
    fresh = fresh.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("before").alias("before"), F.max(F.col("depth") == F.col("length")).alias("ends"))
    fresh = written(fresh, "fresh")
    parting = fresh.groupBy("before").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("before").alias("_parting"))
    begins = fresh.groupBy("conv_id").agg(F.min_by(F.struct((F.col("depth") - 1).alias("top"), F.col("before").alias("parent")), "depth").alias("begin"))
    begins = begins.select(F.col("conv_id").alias("_conv"), "begin")
    stops = fresh.join(parting, F.col("name") == F.col("_parting"), "left").filter(F.col("ends") | F.col("_parting").isNotNull())
    stops = stops.join(begins, F.col("conv_id") == F.col("_conv"))
    path = Window.partitionBy("conv_id").orderBy("depth")
    added = stops.select(
        F.col("name").alias("node"), F.coalesce(F.lag("depth").over(path), F.col("begin.top")).alias("top"), "depth",
        F.coalesce(F.lag("name").over(path), F.col("begin.parent")).alias("parent"), "conv_id")
    kept = nodes.join(cut.select(F.col("edge").alias("_cut")).distinct(), F.col("node") == F.col("_cut"), "left_anti")
    return kept.unionByName(_nodes(written(pieces.unionByName(added), "new-nodes"), paths))


def build(classes: DataFrame, paths: DataFrame, batches: int) -> DataFrame:
    """The compacted trie without its root: ``node, top, depth, parent, conv_id, handle, first``."""
    longest = classes.agg(F.max("length").alias("n")).first().n or 0
    kind = ", ".join(f"{c} {k}" for c, k in zip(NODE, ("binary", "long", "long", "binary", "long", "binary", "binary"), strict=True))
    nodes, empty = classes.sparkSession.createDataFrame([], kind), True
    for number in range(batches):
        batch = classes.filter((F.pmod(F.xxhash64("conv_id"), F.lit(batches)) == number) & (F.col("length") > 0)).select("conv_id", "length")
        if empty:
            located = batch.select(
                "conv_id", "length", F.lit(0).cast("long").alias("exit"), F.lit(None).cast("binary").alias("edge"),
                *[F.lit(None).cast("long").alias(c) for c in ("top", "bottom")])
        else:
            located = written(locate(batch, nodes, paths, longest.bit_length()), "located")
        nodes = written(insert(nodes, located, paths), "trie")
        empty = empty and nodes.isEmpty()
    return nodes


def _subtrees(nodes: DataFrame, classes: DataFrame, paths: DataFrame) -> DataFrame:
    """``node, top, depth, parent, n_children`` and, over the subtree, ``least, n, n_leaves, reach, edges``.

    ``reach`` sums the words of every member up to its end, ``edges`` the words of every edge, ``w_top`` are those up to ``top``.
    """
    reach = [F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth")]
    met = nodes.join(paths.select(*reach, F.col("words").alias("w")), (F.col("conv_id") == F.col("_conv")) & (F.col("depth") == F.col("_depth"))).drop("_conv", "_depth")
    met = met.join(paths.select(*reach, F.col("words").alias("w_top")), (F.col("conv_id") == F.col("_conv")) & (F.col("top") == F.col("_depth")), "left").drop("_conv", "_depth")
    met = met.select("node", "top", "depth", "parent", "w", F.coalesce("w_top", F.lit(0)).alias("w_top"))
    root = nodes.sparkSession.createDataFrame([(ROOT, -1, 0, None, 0, 0)], met.schema)
    children = nodes.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "_parent")
    ends = classes.select(F.col("name").alias("_name"), F.col("conv_id").alias("least"), F.col("weight").alias("n"))
    met = met.unionByName(root).join(children, F.col("node") == F.col("_parent"), "left").join(ends, F.col("node") == F.col("_name"), "left")
    n = F.coalesce("n", F.lit(0))
    fixed = written(met.select(
        "node", "top", "depth", "parent", "w_top", F.coalesce("n_children", F.lit(0)).alias("n_children"), "least", n.alias("n"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"), (n * F.col("w")).alias("reach"), (F.col("w") - F.col("w_top")).alias("edges")), "nodes")
    sums = ["n", "n_leaves", "reach", "edges"]
    state = fixed.select("node", F.col("parent").alias("up"), "least", *sums)
    while not state.filter("up is not null").isEmpty():
        given = state.filter("up is not null").groupBy("up").agg(F.min("least").alias("_least"), *[F.sum(c).alias(f"_{c}") for c in sums])
        above = state.filter("up is not null").select(F.col("node").alias("_of"), F.col("up").alias("_up"))
        more = state.join(given.withColumnRenamed("up", "_to"), F.col("node") == F.col("_to"), "left").select(
            "node", "up", F.least("least", "_least").alias("least"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums])
        more = written(more, "sums")
        top = (F.col("up").isNull()) | (F.col("up") == ROOT)  # the root has nothing above
        climbing = more.filter(~top).join(above, F.col("up") == F.col("_of"), "left").withColumn("up", F.col("_up")).select(more.columns)
        state = written(more.filter(top).withColumn("up", F.lit(None).cast("binary")).unionByName(climbing), "doubled")
    totals = state.select(F.col("node").alias("_node"), "least", *sums)
    return fixed.select("node", "top", "depth", "parent", "w_top", "n_children").join(totals, F.col("node") == F.col("_node")).drop("_node")


def conversation_trie(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """A row per node, each a distinct sequence of first turns: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated rows are turns of their own. A null role or
    text is empty; rows with a null ``conv_id`` belong to no conversation and are left out. Every conversation is rebuilt
    from the first turns of its group's first conversation and its own later turns. Long conversations and long texts
    are neither cut nor gathered. An empty table gives no rows.
    """
    own = written(_own_turns(conversations), "own-turns")
    prefixes = written(_prefixes(_rebuilt(own)), "prefixes")
    ends = prefixes.groupBy("conv_id").agg(F.max("depth").alias("length"), F.max_by("name", "depth").alias("name"))
    every = own.select("conv_id").distinct().withColumnRenamed("conv_id", "_conv")
    members = every.join(ends, F.col("conv_id") == F.col("_conv"), "left").select(
        F.col("_conv").alias("conv_id"), F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("name", F.lit(ROOT)).alias("name"))
    members = written(members, "members")
    classes = written(members.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.max("length").alias("length")), "classes")
    paths = written(prefixes.join(classes.select("conv_id"), "conv_id", "left_semi"), "paths")
    nodes = build(classes, paths, batches)
    # Ids of the members that end at a node.
    several = members.join(classes.filter("weight > 1").select("name"), "name", "left_semi")
    single = classes.filter("weight = 1").select("name", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256).alias("sha256"))
    hashed = _hashed_ids(several).unionByName(single).withColumnRenamed("name", "_name")
    trees = _subtrees(nodes, classes, paths).filter("n > 0").join(hashed, F.col("node") == F.col("_name"), "left").drop("_name")
    trees = written(trees, "subtrees")
    root = trees.filter(F.col("node") == ROOT).select(F.col("least").alias("_least"))  # one row
    below = trees.filter(F.col("node") != ROOT)
    high = below.filter(F.col("parent") == ROOT).crossJoin(F.broadcast(root)).withColumnRenamed("_least", "above")
    deep = below.filter(F.col("parent") != ROOT).join(
        trees.select(F.col("node").alias("_node"), F.col("least").alias("above")), F.col("parent") == F.col("_node")).drop("_node")
    # A row per depth of every edge.
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bottom") - F.col("top") - 1) / RUN))).alias("_run")
    edges = high.unionByName(deep).withColumnRenamed("depth", "bottom").select("*", runs)
    low = F.col("top") + 1 + F.col("_run") * RUN
    steps = edges.select("*", F.explode(F.sequence(low, F.least(low + RUN - 1, "bottom"))).alias("depth"))
    words = paths.select(F.col("conv_id").alias("_conv"), F.col("depth").alias("_depth"), (F.col("words") - F.col("n_words")).alias("w"))
    steps = steps.join(words, (F.col("least") == F.col("_conv")) & (F.col("depth") == F.col("_depth")))
    last, nobody = F.col("depth") == F.col("bottom"), F.lit(hashlib.sha256().hexdigest())
    rows = steps.select(
        F.col("least").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("top") + 1, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("reach") - F.col("n") * F.col("w") - F.col("edges") + F.col("w") - F.col("w_top")).alias("saved_tokens"),
        F.when(last, F.coalesce("sha256", nobody)).otherwise(nobody).alias("ends_sha256"))
    whole = trees.filter(F.col("node") == ROOT).select(
        F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", (F.col("reach") - F.col("edges")).alias("saved_tokens"), F.coalesce("sha256", nobody).alias("ends_sha256"))
    return rows.unionByName(whole)
