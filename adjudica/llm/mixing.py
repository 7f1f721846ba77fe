"""Sources interleaved by target weight: Pfair windows, earliest deadline first.

Each source's documents, in hash order, are cut into blocks of ``block_rows``. With w the source's exact weight among
all, block j may be released in slot floor(j / w) and is due by slot ceil((j + 1) / w); in every slot the released
block with the earliest deadline goes next. As the weights add up to 1, every deadline is met: after t slots a source
has had w * t blocks, give or take less than one, however long the table is. A source that runs out leaves its slots to
blocks released by then, or empty, and the others go on in the proportion of their weights.

Weights are rationals, taken as they are written (0.1 is one tenth), so they are whole numbers of slots of some period,
after which the schedule repeats. If the period is no longer than ``period``, or than the table has blocks, it is worked
out once; block j of a source goes into slot (j div a) * period + slot of (j mod a), with its a slots of a period. Of
weights without such a period (the default ones) every block of the table is worked out. Either way the driver does it,
with integers, in the memory of one entry for each block of a period or of the table.

Every document is placed exactly once; none is dropped or repeated. A document's place among all is the number of rows
in earlier slots, summed up in groups of slots, groups of groups, and so on; nothing is sorted as a whole.

Ranks within a source, however large, come from small sorted runs: rows are dealt by hash into runs of a source, each
run is numbered in a window of its own, and starts at the sum of the runs before.

Defined cases: a null source is a source of its own; any number of sources is allowed, and any weight above zero whose
slots fit 63 bits; a source without a weight when weights are given, or a weight that isn't positive, is refused
(ValueError); rows with equal or null ids are ordered by a hash of their whole content; an empty table gives an empty
result. Input columns come back inside the struct ``row``, so their names can't clash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

BLOCK_ROWS = 16
PERIOD = 1_000
ROWS_PER_RUN = 100_000
# Slots, and groups of them, whose rows are summed up together.
FAN = 1_000
# Up to so many blocks the placed ones are broadcast to the rows.
BROADCAST_BLOCKS = 500_000
# Exponent of the default weights: a source's row share to this power, which moves weight from large to small sources.
SMOOTHING = 0.7


def shares(weights: list[float | Fraction]) -> list[int]:
    """The least integers in exactly the proportion of the weights; a float counts as the decimal it is written as."""
    exact = [Fraction(str(w)) for w in weights]
    if any(w <= 0 for w in exact):
        raise ValueError("weights must be positive")
    scale = math.lcm(*(w.denominator for w in exact))
    whole = [int(w * scale) for w in exact]
    common = math.gcd(*whole)
    return [w // common for w in whole]


def block_schedule(share: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(slot, source number, block number) of each source's first ``blocks``: earliest deadline first among released
    blocks. Slots without a released block are passed over at once."""
    period = sum(share)
    release = [(0, s, 0) for s, n in enumerate(blocks) if n]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while release or ready:
        if not ready:
            slot = max(slot, release[0][0])
        while release and release[0][0] <= slot:
            _, s, j = release[0]
            heapq.heappush(ready, (-(-(j + 1) * period // share[s]), s, j))
            if j + 1 < blocks[s]:
                heapq.heapreplace(release, ((j + 1) * period // share[s], s, j + 1))
            else:
                heapq.heappop(release)
        _, s, j = heapq.heappop(ready)
        yield slot, s, j
        slot += 1


def pfair_schedule(share: list[int]) -> list[tuple[int, int]]:
    """(source number, block number) for each slot of one period."""
    return [(s, j) for _, s, j in block_schedule(share, share)]


def _name(source: Column) -> Column:
    """Sources as text; null is a name of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _rows_before(sizes: DataFrame, slots: int) -> DataFrame:
    """at and start (the sum of n of all lower ones) of ``sizes`` (at, n), at below ``slots``."""
    within = Window.partitionBy("up").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("at", "n", F.expr(f"at div {FAN}").alias("up"))
    own = sizes.select("at", "up", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("start"))
    if slots <= FAN:
        return own.select("at", "start")
    groups = _rows_before(sizes.groupBy(F.col("up").alias("at")).agg(F.sum("n").alias("n")), -(-slots // FAN))
    groups = groups.select(F.col("at").alias("up"), F.col("start").alias("group_start"))
    return own.join(groups, "up").select("at", (F.col("start") + F.col("group_start")).alias("start"))


def placed_blocks(spark: SparkSession, counts: dict[str, int], share: list[int], block_rows: int, period: int) -> DataFrame:
    """name, block, slot and start (rows in earlier slots) of every block of the sources, given their row counts."""
    names = sorted(counts)
    blocks = [-(-counts[s] // block_rows) for s in names]
    cycle_slots = sum(share)
    turns, total = blocks, sum(blocks)
    if repeats := cycle_slots <= max(period, total):
        # Several periods at once, so that neither they nor their repetitions are few.
        times = max(1, max(period, math.isqrt(total)) // max(cycle_slots, 1))
        cycle_slots, turns = times * cycle_slots, [times * a for a in share]
    found = list(block_schedule(share, turns))
    of = pa.array([s for _, s, _ in found], pa.int64())
    per_source = [pa.array(x, t) for x, t in ((names, pa.string()), (turns, pa.int64()), ([counts[s] for s in names], pa.int64()))]
    d = spark.createDataFrame(pa.table({
        "at": pa.array([t for t, _, _ in found], pa.int64()), "turn": pa.array([j for _, _, j in found], pa.int64()),
        **{c: x.take(of) for c, x in zip(("name", "turns", "of_source"), per_source)},
    }))
    if repeats:
        cycles = F.sequence(F.lit(0).cast("long"), F.expr(f"(of_source - 1 - turn * {block_rows}) div (turns * {block_rows})"))
        d = d.where(F.col("turn") * block_rows < F.col("of_source")).withColumn("cycle", F.explode(cycles))
        d = d.withColumn("block", F.col("cycle") * F.col("turns") + F.col("turn")).withColumn("at", F.col("cycle") * cycle_slots + F.col("at"))
        slots = cycle_slots * max((-(-n // a) for n, a in zip(blocks, turns)), default=0)
    else:
        d = d.withColumnRenamed("turn", "block")
        slots = found[-1][0] + 1
    d = d.select("name", "block", "at", F.least(F.lit(block_rows).cast("long"), F.col("of_source") - F.col("block") * block_rows).alias("n"))
    out = d.select("name", "block", "at").join(_rows_before(d.select("at", "n"), slots), "at").select("name", "block", F.col("at").alias("slot"), "start")
    return F.broadcast(out) if total <= BROADCAST_BLOCKS else out


def numbered(documents: DataFrame, source: str, key: str, rows_per_run: int, n_rows: int) -> DataFrame:
    """row (struct of the input), name of the source, and rank: the row's number within its source, in hash order."""
    columns = [F.col(f"`{c}`") for c in documents.columns]
    runs = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // rows_per_run))
    d = documents.select(F.struct(*columns).alias("row"), _name(F.col(f"`{source}`")).alias("name"),
                         F.xxhash64(F.lit(8), F.col(f"`{key}`")).alias("order"), F.xxhash64(*columns).alias("content"))
    d = d.withColumn("run", F.pmod(F.xxhash64("order", "content"), F.lit(runs)).cast("int"))
    sizes = d.groupBy("name", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("name").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("name", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("name", "run").orderBy("order", "content")
    return d.join(starts, ["name", "run"]).select("row", "name", (F.col("start") + F.row_number().over(within) - 1).alias("rank"))


def mixed(documents: DataFrame, weights: dict[str | None, float] | None = None, source: str = "source", key: str = "doc_id",
          block_rows: int = BLOCK_ROWS, period: int = PERIOD, rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """row (struct of the input row), block, slot and position of every row; ordered by position they are the mixture.

    Without ``weights`` a source's weight is its row share to the power ``SMOOTHING``. The driver sees one row for each
    source, and works out ``period`` slots or as many as the table has blocks.
    """
    names = documents.select(_name(F.col(f"`{source}`")).alias("name"))
    counts = {r["name"]: r["n"] for r in names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(counts)
    if weights is None:
        target = [counts[s] ** SMOOTHING for s in order]
    else:
        given = {"" if s is None else f"={s}": w for s, w in weights.items()}
        if missing := [s for s in order if s not in given]:
            raise ValueError(f"no weight for sources {[m[1:] for m in missing]}")
        target = [given[s] for s in order]
    placed = placed_blocks(documents.sparkSession, counts, shares(target), block_rows, period)
    d = numbered(documents, source, key, rows_per_run, sum(counts.values())).withColumn("block", F.expr(f"rank div {block_rows}"))
    return d.join(placed, ["name", "block"]).select("row", "block", "slot", (F.col("start") + F.col("rank") % block_rows).alias("position"))


def in_order(placed: DataFrame) -> DataFrame:
    """The input rows, written in the mixture's order: partitions are ranges of positions, each sorted."""
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents").select("doc_id", "source")).select("row.doc_id", "row.source", "block", "slot", "position")
