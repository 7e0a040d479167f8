"""Best-fit packing: the configuration linear program over the histogram of lengths.

Tokenising writes every piece once, with its rank among its task's pieces of that length. Only the histogram (at most
``capacity`` rows) reaches the driver, where the program is solved by multiplicative weights, its columns priced by a
knapsack dynamic program; its dual bounds the number of sequences. The solution is rounded, and the rest put best-fit
into sequences. Pieces then find their place by arithmetic on (length, rank): no sorting by length, no task that holds
all pieces of one length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, store
from .tokens import grouped, id_memo

#: Rounds of pricing and steps of the shares in each; how sharply weights fall with the cover; how near the best price a
#: configuration must be; the part of a mixture that new ones take; the steps that are tried; the gap at which to stop.
ROUNDS, STEPS, SHARPNESS, NEARNESS, ENTER, MOVES, CLOSE = 20, 20, 10.0, 0.03, 0.2, (1.0, 0.5, 0.2, 0.05, 0.0), 1e-3
#: Scales of a mixture that are tried; columns that stay from round to round, those of the largest shares.
SCALES = tuple(1 + k / 20 for k in range(-4, 21))
MOST_COLUMNS = 1500
#: Shares of the program's solution that are tried in rounding.
SHARES = (1.0, 0.95, 0.8)
#: A worker hands on rows once they hold so many ids.
FLUSH_IDS = 1 << 20


def tokenize_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each row of ``docs`` (doc_id, text): doc_id, piece, start, length,
    ids_crc32, part, nth, and ids (null unless ``keep_ids``).

    A row's ids are those of the tokenizer file without special ones added, then ``end_id``; a null or empty text is
    ``end_id`` alone. Only longer rows are cut; the last piece may be shorter. ``nth`` numbers the pieces of one length
    within the task ``part``. Repeated rows and null ids are packed as rows of their own; other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("nth", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        memo, part, seen = id_memo(path), TaskContext.get().partitionId(), Counter()
        end = np.asarray([end_id], "<u4").tobytes()

        def table(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
            ids, starts, lengths, crcs, doc_ids, pieces, nths = [], [], [], [], [], [], []
            for doc_id, raw in rows:
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    own = raw[at : at + 4 * capacity]
                    length = len(own) // 4
                    doc_ids.append(doc_id)
                    pieces.append(k)
                    starts.append(at // 4)
                    lengths.append(length)
                    crcs.append(zlib.crc32(own))
                    nths.append(seen[length])
                    seen[length] += 1
                    ids.append(own)
            if keep_ids:
                flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat))
            else:
                lists = pa.nulls(len(lengths), pa.list_(pa.int32()))
            columns = [pa.array(doc_ids, id_type), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array([part] * len(lengths), pa.int32()), pa.array(nths, pa.int64()), lists]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            rows, held = [], 0
            ids = (raw for run in grouped(batch.column(1).to_pylist()) for raw in memo.encode(run))
            for doc_id, raw in zip(batch.column(0).to_pylist(), ids, strict=True):
                rows.append((doc_id, raw + end))
                held += len(raw) // 4
                if held >= FLUSH_IDS:
                    yield table(rows, batch.column(0).type)
                    rows, held = [], 0
            if rows:
                yield table(rows, batch.column(0).type)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """best[c]: the most value of items of summed length c at most; item[c]: the last item of such a choice, 0 for none;
    room[c]: what that choice takes of c.

    ``value`` is by length; lengths of no value are never chosen.
    """
    best, item, room = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    lengths = np.flatnonzero(value > 0)
    worth, upto = value[lengths], np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        best[c], item[c], room[c] = best[c - 1], item[c - 1], room[c - 1]
        if k := upto[c]:
            total = worth[:k] + best[c - lengths[:k]]
            j = int(total.argmax())
            if total[j] > best[c]:
                best[c], item[c], room[c] = total[j], lengths[j], c
    return best, item, room


def choices(item: np.ndarray, room: np.ndarray, first: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """For each length of ``first`` the configuration of the most value that holds it, longest item first."""
    left, rows = capacity - first, [first]
    while True:
        left = room[left]
        own = item[left]
        if not own.any():
            break
        rows.append(own)
        left = left - own
    return [tuple(int(x) for x in c if x) for c in -np.sort(-np.stack(rows, 1), axis=1)]


@dataclass
class Solution:
    """Fractional configurations that cover the counts, the least value of the program that was found, and the dual value:
    no packing has fewer sequences."""

    uses: dict[tuple[int, ...], float]
    sequences: float
    bound: float


def first_prices(lengths: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Prices to begin with: the length itself, how many fit side by side, and steps of a part of the capacity."""
    steps = [np.floor((k + 1) * lengths / (capacity + 1)) / k for k in range(1, 9)]
    return [lengths / capacity, 1 / np.floor(capacity / lengths), *[x for x in steps if x.any()]]


def linear_program(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> Solution:
    """The configuration program, min sum x_c with sum a_cl x_c >= counts_l, by multiplicative weights.

    The weight of a length falls with the exponential of its cover by the present mixture of configurations. A round
    prices each length at its weight by count; the knapsack dynamic program gives the configuration of the most price,
    which scales the prices to a solution of the dual, a bound, and the best configuration for each length. Those near
    the best enter the mixture, in the shares of the weights and of their nearness; then the mixture's own shares are
    multiplied up or down by their price at weights that follow the cover, with a step that lowers the sum of the
    weights. The mixture whose least cover is the greatest is handed on, scaled up until it covers all; the value is that of
    the best scale at which configurations of one length each cover the rest.
    """
    lengths = np.flatnonzero(counts)
    m = len(lengths)
    if not m:
        return Solution({}, 0.0, 0.0)
    need = counts[lengths].astype(float)
    place = np.zeros(capacity + 1, np.int64)
    place[lengths] = np.arange(m)
    target = float((lengths * need).sum()) / capacity

    def priced(each: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        price = np.zeros(capacity + 1)
        price[lengths] = each
        best, item, room = knapsack(price, capacity)
        return float((each * need).sum() / best[capacity]), (each + best[capacity - lengths]) / best[capacity], item, room

    bound, each = max((priced(x)[0], k) for k, x in enumerate(first_prices(lengths, capacity)))
    weight = first_prices(lengths, capacity)[each] * need
    columns: list[tuple[int, ...]] = []
    alone = need / np.floor(capacity / lengths)
    shares, cover, least, most, uses = np.zeros(0), np.zeros(m), math.inf, 0.0, {}
    for k in range(rounds):
        weight = weight / weight.sum()
        value, near, item, room = priced(weight / need)
        bound = max(bound, value)
        mass = weight * np.exp((near - near.max()) / NEARNESS)
        kept = mass > 1e-4 * mass.max()
        place_of = {c: i for i, c in enumerate(columns)}
        found, mass = choices(item, room, lengths[kept], capacity), mass[kept] / mass[kept].sum()
        columns += [c for c in dict.fromkeys(found) if c not in place_of]
        place_of = {c: i for i, c in enumerate(columns)}
        fresh = np.zeros(len(columns))
        np.add.at(fresh, [place_of[c] for c in found], mass)
        shares = np.concatenate([shares, np.zeros(len(columns) - len(shares))])
        shares = fresh if not k else (1 - ENTER) * shares + ENTER * fresh
        items = np.full((len(columns), max(map(len, columns))), m)
        for i, c in enumerate(columns):
            items[i, : len(c)] = place[list(c)]

        def covers(of: np.ndarray, items: np.ndarray = items) -> np.ndarray:
            return np.bincount(items.ravel(), np.repeat(of, items.shape[1]), minlength=m + 1)[:m] * target / need

        cover = covers(shares)
        for _ in range(STEPS):
            gain = np.append(np.exp(-SHARPNESS * (cover - cover.min())) / need, 0.0)[items].sum(1)
            moved = shares * np.exp(np.clip(2 * (gain / (shares @ gain) - 1), -2, 2))
            moved /= moved.sum()
            towards = covers(moved)
            sums = [np.exp(-SHARPNESS * ((1 - t) * cover + t * towards - cover.min())).sum() for t in MOVES]
            t = MOVES[int(np.argmin(sums))]
            if not t:
                break
            shares, cover = (1 - t) * shares + t * moved, (1 - t) * cover + t * towards
        totals = [target * x + float((np.maximum(0, 1 - x * cover) * alone).sum()) for x in SCALES]
        least = min(least, *totals)
        if cover.min() > most:
            most = float(cover.min())
            uses = {c: x * target / most for c, x in zip(columns, shares.tolist(), strict=True) if x > 0}
        weight = np.exp(-SHARPNESS * (cover - cover.min()))
        if least <= bound * (1 + CLOSE):
            break
        kept = np.sort(np.argsort(-shares, kind="stable")[:MOST_COLUMNS])
        columns, shares = [columns[i] for i in kept.tolist()], shares[kept] / shares[kept].sum()
    return Solution(uses, least, bound)


def rounded(uses: dict[tuple[int, ...], float], counts: np.ndarray, share: float) -> tuple[Counter, np.ndarray]:
    """Whole uses of the configurations, ``share`` of each and one more while all its items are left; and what is left."""
    left, plan = counts.copy(), Counter()
    ordered = sorted(uses.items(), key=lambda x: (-x[1], x[0]))
    for extra in (False, True):
        for c, x in ordered:
            times = 1 if extra else int(x * share)
            if times:
                own = Counter(c)
                times = min([times, *(int(left[y]) // m for y, m in own.items())])
                if times > 0:
                    plan[c] += times
                    for y, m in own.items():
                        left[y] -= m * times
    return plan, left


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Lengths from the longest down, each into the open sequences with the least room that holds it, in bulk."""
    room: dict[int, Counter] = {}
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            fits = [c for c in room if c >= length]
            if fits:
                c = min(fits)
                items, k = room[c].popitem()
                take = min(n, k)
                if k > take:
                    room[c][items] = k - take
                if not room[c]:
                    del room[c]
                room.setdefault(c - length, Counter())[(*items, length)] += take
            else:
                each = capacity // length
                take, rest = divmod(n, each)
                # As many to a sequence as go in; what is left over opens one more.
                if take:
                    room.setdefault(capacity - each * length, Counter())[(length,) * each] += take
                if rest:
                    room.setdefault(capacity - rest * length, Counter())[(length,) * rest] += 1
                take = n
            n -= take
    out: Counter = Counter()
    for group in room.values():
        out.update(group)
    return out


def solve(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], float]:
    """Configurations (lengths, longest first) and how often each is used, which together hold ``histogram`` exactly, and
    the bound that the program's dual gives on the number of sequences.

    The solution of the program is rounded down to several shares, what is left goes best-fit, and the plan of the fewest
    sequences stays; best fit alone is one of them, so none is worse.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    full, counts[capacity] = int(counts[capacity]), 0
    solution = linear_program(counts, capacity)
    best: Counter | None = None
    for share in (*SHARES, 0.0):
        plan, left = rounded(solution.uses if share else {}, counts, share)
        plan.update(best_fit({int(x): int(left[x]) for x in np.flatnonzero(left)}, capacity))
        if best is None or plan.total() < best.total():
            best = plan
        if best.total() <= math.ceil(solution.bound - 1e-6):
            break
    if full:
        best[(capacity,)] += full
    return sorted(best.items(), reverse=True), solution.bound + full


def slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Sorted by (length, first rank): key, first rank, pieces of that length in a sequence, first sequence, first offset."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for items, times in plan:
        at = 0
        for length, m in sorted(Counter(items).items(), reverse=True):
            rows.append((length, ranks[length], m, sequence, at))
            ranks[length] += m * times
            at += m * length
        sequence += times
    rows.sort()
    table = np.asarray(rows, dtype=np.int64).reshape(-1, 5)
    return (table[:, 0] << 44) + table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4]


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` as ``tokenize_pieces`` gives them, with sequence_id and offset in place of part and nth.

    Every sequence holds ``capacity`` ids at most, gapless from offset 0. The pieces are written to the shared folder
    first, as ranks must be the same in each pass. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    pieces = store(pieces, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(slots(solve(histogram, capacity)[0]))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keys, ranks, many, sequences, offsets = plan.value
        for length, rank in batches:
            length, rank = length.to_numpy(), rank.to_numpy()
            k = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            within = rank - ranks[k]
            yield pd.DataFrame({"sequence_id": sequences[k] + within // many[k], "offset": offsets[k] + within % many[k] * length})

    return (
        pieces.join(first, ["part", "length"])
        .withColumn("_at", place(F.col("length"), F.col("_first") + F.col("nth")))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "_at.sequence_id", "_at.offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and ids, from ``pack`` over pieces that keep their ids."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda x: x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, keep_ids: bool = True) -> DataFrame:
    """Tokenise and pack ``docs``; see ``tokenize_pieces`` and ``pack``."""
    return pack(tokenize_pieces(docs, path, capacity, keep_ids=keep_ids), capacity)


COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False).select(*COLUMNS)


QUERIES = {"op5_packing": op5_packing}
ORACLE: dict[str, str] = {}
