"""Filling containers of fixed capacity with items, by exact complements of their lengths.

Only the histogram of lengths, which has at most ``capacity`` rows a pack, is planned in one place, by a task for each pack. The planner opens a container with
the longest item left, looks up single lengths, pairs and triples that fill the gap exactly, and where there is none adds the
longest item that fits and looks again. Each plan is used as often as the counts of its lengths allow, so there are never
more plans than lengths. Items find their slot by their rank among the items of their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosta.session import written


@dataclass
class Plan:
    """Slots by length: items of ``length[i]`` with ranks from ``start[i]`` on go to container ``first[i] + (rank - start[i]) // times[i]``."""

    length: np.ndarray
    start: np.ndarray
    first: np.ndarray
    times: np.ndarray
    containers: int


def _exact(gap: int, left: np.ndarray, pairs: np.ndarray) -> list[int] | None:
    """One, two or three available lengths that sum to ``gap``, the longest first; ``pairs`` counts the pairs of lengths by their sum.

    The third length is looked for among all that leave the sum of a pair. A pair of one length with itself may be there once only, so
    a candidate can fail; then the next one is tried, to the last.
    """
    if left[gap] > 0:
        return [gap]
    two = _pair(gap, left)
    if two:
        return two
    third = np.flatnonzero((left[1:gap] > 0) & (pairs[gap - 1 : 0 : -1] > 0)) + 1
    for c in third[::-1].tolist():
        left[c] -= 1
        two = _pair(gap - c, left)
        left[c] += 1
        if two:
            return [c, *two]
    return None


def _pair(total: int, left: np.ndarray) -> list[int] | None:
    half = total // 2
    if half < 1:
        return None
    short = np.flatnonzero((left[1 : half + 1] > 0) & (left[total - 1 : total - half - 1 : -1] > 0)) + 1
    for a in short[::-1][:2].tolist():  # only half of the sum can fail, so one of the two longest fits if any does
        if 2 * a != total or left[a] > 1:
            return [total - a, a]
    return None


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """Slots for a histogram of lengths between 1 and ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] += n
    used = np.zeros(capacity + 1, np.int64)
    slots: list[tuple[int, int, int, int]] = []
    container = 0
    # pairs of available lengths by their sum, each order counted; kept up as lengths run out
    width = 1 << (2 * capacity + 1).bit_length()
    spectrum = np.fft.rfft((left > 0).astype(np.float64), width)
    pairs = np.rint(np.fft.irfft(spectrum * spectrum, width)[: capacity + 1]).astype(np.int64)
    live = left > 0
    while live.any():
        gone = np.flatnonzero(live & (left <= 0))
        for size in gone.tolist():
            others = np.flatnonzero(live[: capacity - size + 1])
            pairs[size + others] -= 2
            if 2 * size <= capacity:
                pairs[2 * size] += 1  # with itself it was counted once
            live[size] = False
        if not live.any():
            break
        inside: dict[int, int] = {}
        gap = capacity
        while gap > 0:
            top = np.flatnonzero(left[: gap + 1] > 0)
            if not len(top):
                break
            found = _exact(gap, left, pairs) if inside else None
            chosen = found or [int(top[-1])]
            for size in chosen:
                left[size] -= 1
                inside[size] = inside.get(size, 0) + 1
                gap -= size
        # the same container again, as often as its lengths allow; with a gap only while nothing that is left would fit it
        again = min(int(left[size]) // n for size, n in inside.items())
        if gap > 0 and np.flatnonzero(left[: gap + 1] > 0).size:
            again = 0
        for size, n in inside.items():
            slots.append((size, int(used[size]), container, n))
            used[size] += n * (again + 1)
            left[size] -= n * again
        container += again + 1
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], container)


def place(plan_: Plan, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Container of each item of given length and rank."""
    key = plan_.length * (1 << 40) + plan_.start
    at = np.searchsorted(key, size * (1 << 40) + rank, "right") - 1
    return plan_.first[at] + (rank - plan_.start[at]) // plan_.times[at]


def pack(sizes: DataFrame, key: str, tokens: str, packs: list[tuple[str, str, int]], by: str = "tokenizer") -> DataFrame:
    """(pack_name, key, piece_no, container, tokens): every item of every pack in containers of that pack's capacity.

    sizes: one row per item and tokenizer, with the column ``by``. packs: (name, tokenizer, capacity). An item longer than the
    capacity is cut into full pieces, each of which fills a container of its own (named ``s<key>.<piece>``), and a rest that is
    packed like any item; no other item is cut. Mixed containers are named ``m<number>``. Items of length 0 or null take no room
    and are spread over the mixed containers. A key that repeats is packed once for each row. An empty table gives none.
    """
    spark = sizes.sparkSession
    named = spark.createDataFrame(packs, "pack_name string, _by string, capacity int")
    base = sizes.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{by}`").alias("_by"), F.coalesce(F.col(f"`{tokens}`"), F.lit(0)).cast("int").alias("_tokens")).join(named, "_by")
    base = base.select("pack_name", "_key", "_tokens", "capacity", F.floor(F.col("_tokens") / F.col("capacity")).cast("int").alias("_full"), (F.col("_tokens") % F.col("capacity")).alias("_rest"))
    base = base.withColumn("_full", F.when(F.col("_rest") == 0, F.greatest(F.col("_full") - 1, F.lit(0))).otherwise(F.col("_full")))
    base = written(base.withColumn("_rest", F.col("_tokens") - F.col("_full") * F.col("capacity")), "sizes")
    # ranks within a length: numbered in parts, so that a length that many items share is no single task
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    rest = base.withColumn("_part", F.pmod(F.xxhash64("_key"), F.lit(parts)).cast("int"))
    count = written(rest.groupBy("pack_name", "_rest", "_part").agg(F.count("*").alias("_n")), "counts")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("pack_name", "_rest").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offset = count.select("pack_name", "_rest", "_part", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("pack_name", "_rest", "_part").orderBy("_key")) - 1
    ranked = rest.withColumn("_rank", rank).join(offset, ["pack_name", "_rest", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # at most ``capacity`` lengths per pack, planned by one task a pack; the driver receives no more plans than lengths
    sizes_of = {name: capacity for name, _, capacity in packs}

    def planned(table):  # noqa: ANN001, ANN202 - the histogram of one pack
        import pyarrow as pa

        name = table.column("pack_name")[0].as_py()
        counts = dict(zip(table.column("_rest").to_pylist(), table.column("n").to_pylist(), strict=True))
        p = plan({size: n for size, n in counts.items() if size > 0}, sizes_of[name])
        # a last row holds the number of containers
        columns = [np.append(c, x) for c, x in zip((p.length, p.start, p.first, p.times), (0, 0, p.containers, 0), strict=True)]
        return pa.table([pa.array([name] * len(columns[0])), *[pa.array(c, pa.int64()) for c in columns]], names=["pack_name", "length", "start", "first", "times"])

    lengths = count.groupBy("pack_name", "_rest").agg(F.sum("_n").alias("n"))
    rows = lengths.groupBy("pack_name").applyInArrow(planned, "pack_name string, length bigint, start bigint, first bigint, times bigint").collect()
    plans = {}
    for name in sizes_of:
        table = np.array(sorted((r.length, r.start, r.first, r.times) for r in rows if r.pack_name == name and r.length > 0), np.int64).reshape(-1, 4)
        plans[name] = Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], max((r["first"] for r in rows if r.pack_name == name and r.length == 0), default=0))
    shared = spark.sparkContext.broadcast(plans)

    def assign(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            names, size, order = (given.column(n).to_numpy(zero_copy_only=False) for n in ("pack_name", "_rest", "_rank"))
            out = np.zeros(len(names), np.int64)
            for name in set(names):
                mine = names == name
                p = shared.value[name]
                full = mine & (size > 0)
                out[full] = place(p, size[full].astype(np.int64), order[full].astype(np.int64))
                empty = mine & (size == 0)
                out[empty] = order[empty].astype(np.int64) % max(1, p.containers)
            yield pa.RecordBatch.from_arrays([given.column("pack_name"), given.column("_key"), given.column("_full"), given.column("_rest"), pa.array(out)], names=["pack_name", "_key", "_full", "_rest", "_container"])

    kind = dict(base.dtypes)["_key"]
    placed = ranked.select("pack_name", "_key", "_full", "_rest", "_rank").mapInArrow(assign, f"pack_name string, _key {kind}, _full int, _rest int, _container bigint")
    mixed = placed.select("pack_name", F.col("_key").alias(key), F.col("_full").alias("piece_no"), F.concat(F.lit("m"), F.col("_container")).alias("container"), F.col("_rest").alias("tokens"))
    pieces = base.filter("_full > 0").withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_full") - 1)))
    whole = pieces.select("pack_name", F.col("_key").alias(key), F.col("_piece").alias("piece_no"), F.concat(F.lit("s"), F.coalesce(F.col("_key").cast("string"), F.lit("")), F.lit("."), F.col("_piece")).alias("container"), F.col("capacity").alias("tokens"))
    return mixed.unionByName(whole)


def fill(packed: DataFrame, packs: list[tuple[str, str, int]]) -> DataFrame:
    """(pack_name, capacity, containers, tokens, unused) of a packing."""
    capacity = packed.sparkSession.createDataFrame([(n, c) for n, _, c in packs], "pack_name string, capacity int")
    used = packed.groupBy("pack_name", "container").agg(F.sum("tokens").alias("used"))
    out = used.groupBy("pack_name").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens")).join(capacity, "pack_name")
    return out.select("pack_name", "capacity", "containers", "tokens", (F.col("containers") * F.col("capacity") - F.col("tokens")).alias("unused"))
