"""Mixing sources to target weights. DataFrame functions only.

1. The words of a source, document after document, are packed into blocks of ``block_words``; the last may be shorter.
2. Targets: every source gets a share by its weight, at most ``most`` times its own size; what is cut off goes to the
   others by weight. That is a water level found from the sources sorted by the level at which they fill up.
3. The output is a row of shards of ``shard_blocks`` slots. A shard gives each source the whole part of its expected
   number of slots; the slots left over are multinomial draws by the fractional parts (residual sampling, which keeps
   the counts multinomial in mean and nearer to the targets than plain draws).
4. The k-th slot of a source takes the block at position k of a pseudorandom permutation of the source's block numbers,
   a Feistel network with cycle walking; each further round over the source uses another one. Blocks are joined by
   number. All randomness is a hash of seed and position, so reruns agree.

For scale: positions within a source are prefix sums in two levels, so a source with a third of all rows is no single
group; slots and blocks meet on (source, number), which spreads evenly. Windows hold a row per source, per cell or per
shard of a source. Only counts and sizes are shuffled, never texts. Whatever has rows by document, block, slot or draw is
joined by sorting: Spark sizes an exploded range by the few bytes that it is listed from, and stored numbers by their
compressed files, and would send millions of rows through the driver as a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vecferry.llm.common import WORD, unused, written

ROUNDS = 4
WALK = 64  # steps outside the range that cycle walking may take; the chance to need more is below 2 ** -64
GRID = 1024  # cells that spread the draws over the sources
MOST_SHARDS = 1 << 16  # a larger mix gets larger shards, so that a source has no more rows of counts than this
TASK_SLOTS = 250_000  # slots that one task lists


@dataclass(frozen=True)
class Mix:
    """``documents``: _row, doc_id, size, source; ``sources``: a row per source; ``taken``: _row, round, first, words."""

    documents: DataFrame
    sources: DataFrame
    taken: DataFrame


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``source, source_size, target`` by water filling; ``sizes`` has ``source, source_size``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1).cast("int")
    weighted = sizes.withColumn("place", place).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights) + 1))
    filled = weighted.withColumn("cap", F.col("source_size") * float(most)).withColumn("level", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("level", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything).cast("double")
    left = total - F.coalesce(F.sum("cap").over(rising), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    tried = filled.withColumn("water", left / open_weight)  # the level if this source and all fuller ones stay open
    # The first source that does not fill up at its own water level fixes the level for all that follow.
    first = F.min_by("water", F.when(F.col("water") <= F.col("level"), F.col("level"))).over(everything)
    return tried.withColumn("water", first).select(
        "place", "source", "source_size", F.least("cap", F.coalesce(F.col("water") * F.col("weight"), "cap")).alias("target"))


def _hash01(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def _feistel(x: Column, side: Column, *salt: Column) -> Column:
    left, right = F.floor(x / side).cast("long"), F.pmod(x, side)
    for r in range(ROUNDS):
        left, right = right, F.pmod(left + F.pmod(F.xxhash64(right, F.lit(r), *salt), side), side)
    return left * side + right


def permuted(x: Column, n: Column, *salt: Column) -> Column:
    """A pseudorandom permutation of 0 .. n - 1 applied to ``x``."""
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    once = _feistel(x, side, *salt)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), once, lambda at, _: F.when(at < n, at).otherwise(_feistel(at, side, *salt)))
    return F.when(once < n, once).otherwise(walk)


def mix(
    documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block_words: int = 32,
    shard_blocks: int = 4096, cell_rows: int = 20_000, seed: int = 7, rows: Column | None = None,
) -> Mix:
    """Chooses what the mix takes; nulls are sizes of 0 or the last source. An empty table gives empty tables.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. The mix is as long as all documents
    together. No block is taken more than ``most`` times. Repeated rows are documents of their own.
    """
    row = F.monotonically_increasing_id() if rows is None else rows
    sized = written(documents.select(
        row.alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size")), "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = written(
        source_targets(sizes, weights, most).withColumn("n_blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("slots", F.coalesce(F.try_divide("target", "source_size") * F.col("n_blocks"), F.lit(0.0))), "sources")

    totals = sources.agg(F.sum("slots"), F.sum("source_size")).first()
    n_slots = round(totals[0] or 0)
    shard_blocks = max(shard_blocks, -(-n_slots // MOST_SHARDS))
    n_shards = -(-n_slots // shard_blocks)
    # Positions of documents in their source: cells of some cell_rows documents, then documents within a cell.
    cells = max(1, -(-sized.count() // cell_rows))
    dealt = sized.filter("size > 0").withColumn("cell", F.pmod(F.xxhash64("_row"), F.lit(cells)))
    per_cell = dealt.groupBy("source", "cell").agg(F.sum("size").alias("_in_cell"))
    before = F.sum("_in_cell").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_cell.select(F.col("source").alias("_s"), F.col("cell").alias("_c"), F.coalesce(before, F.lit(0)).alias("cell_start"))
    within = F.sum("size").over(Window.partitionBy("source", "cell").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn("within", F.coalesce(within, F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("cell") == F.col("_c")))
    places = sources.select(F.col("source").alias("_name"), "place")
    placed = placed.withColumn("start", F.col("cell_start") + F.col("within")).join(
        places, F.col("source").eqNullSafe(F.col("_name"))).select("_row", "place", "size", "start")
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words).cast("long")
    blocks = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words).cast("long"), last)))
    low = F.greatest(F.col("block") * block_words, "start")
    high = F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size"))
    blocks = blocks.select("_row", "place", "block", (low - F.col("start")).alias("first"), (high - low).alias("words"))

    # Slots per shard and source: whole parts, then draws for the rest.
    shard_size = F.when(F.col("shard") == n_shards - 1, n_slots - (n_shards - 1) * shard_blocks).otherwise(shard_blocks)
    share = sources.filter("slots > 0").select("place", "n_blocks", (F.col("slots") / float(totals[0] or 1)).alias("share"))
    shards = share.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_shards, 1) - 1).cast("long"))))
    shards = shards.withColumn("expected", F.col("share") * shard_size).withColumn("whole", F.floor("expected"))
    rest = F.col("expected") - F.col("whole")
    up_to = Window.partitionBy("shard").orderBy("place")
    of_shard = Window.partitionBy("shard")
    residual = written(shards.select(
        "shard", "place", F.col("whole").cast("long").alias("whole"), (F.sum(rest).over(up_to) - rest).alias("low"),
        F.sum(rest).over(up_to).alias("high"), F.sum(rest).over(of_shard).alias("all_rest"),
        (shard_size - F.sum("whole").over(of_shard)).cast("long").alias("n_left"),
        (F.row_number().over(up_to) == F.count("*").over(of_shard)).alias("is_last")), "residual")
    left = residual.filter("is_last and n_left > 0").select("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_left"))).alias("draw"))
    left = left.withColumn("at", _hash01(F.lit(seed), F.col("shard"), F.col("draw"))).withColumn("grid", F.floor(F.col("at") * GRID).cast("int"))
    bounds = residual.filter("low < high").select(
        F.col("shard").alias("_shard"), "place", F.try_divide("low", "all_rest").alias("low"),
        F.when(F.col("is_last"), 1.0).otherwise(F.try_divide("high", "all_rest")).alias("high"))
    cell_of = lambda c: F.least(F.floor(c * GRID), F.lit(GRID - 1)).cast("int")
    bounds = bounds.withColumn("_grid", F.explode(F.sequence(cell_of(F.col("low")), cell_of(F.col("high")))))
    drawn = left.hint("merge").join(bounds, (F.col("shard") == F.col("_shard")) & (F.col("grid") == F.col("_grid")))
    drawn = drawn.filter("at >= low and at < high").groupBy("shard", "place").agg(F.count("*").alias("drawn"))
    counts = residual.select("shard", "place", F.col("whole").alias("n")).unionByName(drawn.select("shard", "place", F.col("drawn").alias("n")))
    counts = counts.groupBy("shard", "place").agg(F.sum("n").alias("n")).filter("n > 0")
    first_slot = F.sum("n").over(Window.partitionBy("place").orderBy("shard")) - F.col("n")
    slots = counts.withColumn("from", first_slot).join(sources.select("place", "n_blocks"), "place")
    slots = slots.repartition(-(-max(n_slots, 1) // TASK_SLOTS), "place", "shard")  # a few bytes of counts stand for many slots
    slots = slots.withColumn("k", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1))).filter(
        F.col("k") < F.col("n_blocks") * most)  # a draw beyond the last round finds no block left
    slots = slots.withColumn("round", F.floor(F.col("k") / F.col("n_blocks")).cast("long"))
    chosen = slots.select("place", "round", permuted(
        F.pmod(F.col("k"), F.col("n_blocks")), F.col("n_blocks"), F.lit(seed), F.col("place"), F.col("round")).alias("block"))
    taken = blocks.hint("merge").join(chosen, ["place", "block"]).select("_row", "round", "first", "words")
    return Mix(sized, sources, taken)


def mix_counts(documents: DataFrame, **options) -> DataFrame:
    """A row per document: ``doc_id, size, source_size, target, taken``."""
    made = mix(documents, **options)
    taken = made.taken.groupBy("_row").agg(F.sum("words").alias("taken"))
    sources = made.sources.select(F.col("source").alias("_name"), "source_size", "target")
    met = made.documents.hint("merge").join(taken, "_row", "left").join(sources, F.col("source").eqNullSafe(F.col("_name")), "left")
    return met.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_documents(documents: DataFrame, **options) -> DataFrame:
    """The mixed documents, all their columns: a row per document and round with the words taken in that round.

    A document taken whole keeps its text unchanged; of one taken in part the words taken stay, joined by a space.
    ``n_chars``, where there is one, follows the text. Documents of which nothing is taken go, and so do those without
    a word, as there is nothing to take.
    """
    row = unused("_row", documents.columns)
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    made = mix(numbered, rows=F.col(row), **options)
    parts = made.taken.groupBy("_row", "round").agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"), F.sum("words").alias("words"))
    parts = parts.hint("merge").join(made.documents.select("_row", "size"), "_row")
    of, cut = (unused(n, [*numbered.columns, row]) for n in ("_of", "_parts"))
    parts = parts.select(F.col("_row").alias(of), F.when(F.col("words") < F.col("size"), F.col("parts")).alias(cut))
    met = numbered.hint("merge").join(parts, F.col(row) == F.col(of))

    def taken(words: Column) -> Column:
        pieces = F.transform(cut, lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")))
        return F.array_join(F.flatten(pieces), " ")

    # The words are bound by an outer transform, so that they are found once per document and not once per piece.
    some = F.transform(F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"))), taken)[0]
    met = met.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(some))
    if "n_chars" in documents.columns:
        met = met.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return met.select(*documents.columns)
