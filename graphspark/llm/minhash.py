"""Near duplicates by bottom-k sketches of one hash function.

Rows with equal shingle sets form classes, and classes are compared. Every class keeps its ``K`` least shingle hashes.
Inverted lists of these values give overlaps, and a class is listed only under its rarest values: two sketches that
share ``needed`` values share one of the rarest len - needed + 1 of each, so frequent values need no lists. A list first
links its members to one pivot; members that end in one component need no further pair. Open lists then count the
overlaps of what is still apart, in cells by size and blocks of bounded size, and cells in which many are alike are
verified as a whole. The union of two sketches estimates the similarity, and what may reach the threshold is verified on the
full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import runs, shingles, text_buffer
from .common import hot_keys, read, salted_join, store, text_digest
from .graphs import components

#: Values of a sketch; the chance that a pair at the threshold has too few of them in common.
K, MISS = 64, 1e-9
#: Ids that may be broadcast (about 40 bytes each).
BROADCAST_ROWS = 400_000
#: Members of a list that a task compares with as many others.
BLOCK = 2048
#: Shingles of a side of a cell; pairs that are alike, for each member of a cell, beyond which it is compared as a whole.
SHINGLES, DENSE = 1 << 20, 8


@lru_cache(maxsize=16)
def needed(threshold: float, k: int = K, miss: float = MISS) -> int:
    """How many of the ``k`` least values of a union two sets at the threshold share, but for a chance of ``miss``."""
    total, n = 0.0, 0
    while n < k:
        total += math.comb(k, n) * threshold**n * (1 - threshold) ** (k - n)
        if total > miss:
            break
        n += 1
    return max(1, n)


def sketches(docs: DataFrame, width: int, k: int = K, whole: bool = False) -> DataFrame:
    """doc_id, n_shingles, digest (null for an empty set) and sketch of each row of ``docs`` (doc_id, text), and with
    ``whole`` its text_digest."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in runs(np.diff(offsets)):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                sets = list(shingles(part, own, width))
                columns = [
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:k].astype(np.int64) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns, *[x.slice(a, b - a) for x in batch.columns[2:]]], names=["doc_id", "n_shingles", "digest", "sketch", "text_digest"][: 2 + batch.num_columns])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *[text_digest(F.col("text")).alias("text_digest")] * whole)
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles long, digest binary, sketch array<long>" + ", text_digest binary" * whole)


def _alike(percent: int, k: int) -> Column:
    """If the sets of a row's two sides (n, sketch; _n, _sketch) may reach the threshold, by their sizes and by the union
    of their sketches."""
    sizes = F.least("n", "_n") * 100 >= F.greatest("n", "_n") * percent
    both, either = F.array_intersect("sketch", "_sketch"), F.array_union("sketch", "_sketch")
    shared = F.size(F.array_intersect(both, F.slice(F.array_sort(either), 1, k)))
    # A sketch of a set of up to k shingles is the set.
    whole = F.greatest("n", "_n") <= k
    return sizes & F.when(whole, F.size(both) * 100 >= F.size(either) * percent).otherwise(shared >= needed(percent / 100, k))


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _texts(docs: DataFrame, digests: DataFrame, classes: DataFrame) -> DataFrame:
    """digest and text of the rows that stand for the classes; where a doc_id is repeated, also of its other rows."""
    wanted = store(digests.distinct().join(classes.select("digest", "doc_id"), "digest"), "wanted")
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"])
    return store(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(_bounded(wanted), same).select("digest", "text"), "texts")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) of classes whose full sets reach the threshold."""
    n_pairs = pairs.count()
    texts = _texts(docs, pairs.select(F.col("a").alias("digest")).union(pairs.select("b")), classes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last: tuple[bytes, str, np.ndarray] | None = None

        def sets(digests: list[bytes], column) -> list[np.ndarray | None]:
            """By row the set, if it is the one of the class; rows that follow one another often have the same text."""
            nonlocal last
            out = []
            for digest, text in zip(digests, column, strict=True):
                if last is None or last[0] != digest or last[1] != text:
                    data = np.frombuffer(text.encode(), np.uint8)
                    last = (digest, text, next(shingles(data, np.asarray([0, len(data)]), width)))
                out.append(last[2])
            return out

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = sets(a, batch.column(2).to_pylist()), sets(b, batch.column(3).to_pylist())
            good = []
            for x, y, s, t in zip(a, b, left, right, strict=True):
                both = np.concatenate([s, t])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                right_text = hashlib.md5(s.tobytes()).digest() == x and hashlib.md5(t.tobytes()).digest() == y
                good.append(right_text and 100 * shared >= percent * (len(both) - shared))
            keep = np.flatnonzero(good)
            yield batch.select([0, 1]).take(pa.array(keep))

    one, two = texts.select(F.col("digest").alias("b"), F.col("text").alias("_tb")), texts.select(F.col("digest").alias("a"), F.col("text").alias("_ta"))
    both = pairs.select("a", "b")
    # Either side may be a class that much is alike to. A repeated doc_id may give a class more texts than one: no matter.
    for side, table, other in (("b", one, "a"), ("a", two, "b")):
        hot = hot_keys(pairs.groupBy(side).agg(F.count("*").alias("_n")), side, n_pairs)
        both = salted_join(both, table, side, hot, [other])
    return both.select("a", "b", "_ta", "_tb").mapInArrow(run, "a binary, b binary").distinct()


def _listed(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """The inverted lists: value, digest, rank; each class under the rarest of its values that others have too.

    rank orders a class by how common its values are: the middle of a group of copies comes last.
    """
    values = classes.select("digest", "n", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("_df")).where(F.col("_df") > 1)
    size = F.least(F.col("n"), F.lit(k))
    least = F.least(F.lit(needed(percent / 100, k)), F.ceil(F.col("n") * percent / 100))
    # Values that no other class has come first; they take up places but need no lists.
    own = values.join(shared, "value").groupBy("digest", "n").agg(F.array_sort(F.collect_list(F.struct("_df", "value"))).alias("_v"), F.sum("_df").alias("_sum"))
    places = (size - least + 1) - (size - F.size("_v"))
    rank = F.struct(F.col("_sum") / size, "digest").alias("rank")
    picked = own.where(places > 0).select("digest", rank, F.explode(F.slice("_v", F.lit(1), places.cast("int"))).alias("_v"))
    return picked.select(F.col("_v.value").alias("value"), "digest", "rank")


def links(docs: DataFrame, classes: DataFrame, width: int, percent: int, k: int = K) -> DataFrame:
    """Verified links (a, b) between ``classes`` (digest, doc_id, n, sketch); together they join all that is near."""
    lists = store(_listed(classes, percent, k), "lists")
    members = store(classes.join(_bounded(store(lists.select("digest").distinct(), "listed")), "digest"), "members")
    sides = members.select("digest", "n", "sketch")
    other = members.select(F.col("digest").alias("b"), F.col("n").alias("_n"), F.col("sketch").alias("_sketch"))
    pivots = lists.groupBy("value").agg(F.max("rank").alias("_p"))
    starred = lists.join(pivots, "value").where(F.col("digest") != F.col("_p.digest")).select(F.col("_p.digest").alias("digest"), F.col("digest").alias("b"))
    starred = store(starred.distinct(), "starred")
    hot = hot_keys(starred.groupBy("digest").agg(F.count("*").alias("_n")), "digest", starred.count())
    likely = salted_join(starred, sides, "digest", hot, ["b"]).join(other, "b").where(_alike(percent, k)).select(F.col("digest").alias("a"), "b")
    first = store(_verified(docs, store(likely, "pairs"), members, width, percent), "verified")
    roots = store(components(first).withColumnsRenamed({"node": "digest"}), "roots")
    marked = lists.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    # Lists whose members are still apart, those of one pivot as one.
    chief = marked.groupBy("value").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.max("rank").alias("_p")).where(F.col("_low") != F.col("_high"))
    apart = marked.join(chief.select("value", F.col("_p.digest").alias("pivot")), "value").select("pivot", "digest", "root").distinct()
    met = store(_overlaps(apart.join(sides, "digest"), percent, k), "met")
    dense = _dense(docs, met.where(F.col("cell").isNotNull()), members, width, percent)
    pairs = met.where(F.col("cell").isNull()).select("a", "b").distinct().join(first.select("a", "b").union(first.select("b", "a")), ["a", "b"], "left_anti")
    return first.union(store(_verified(docs, store(pairs, "pairs"), members, width, percent), "verified")).union(dense)


class Counter:
    """How many values each of some sets has in common with each of others, by inverted lists of the others' values."""

    def __init__(self, far: list[np.ndarray]):
        values, holder = np.concatenate([np.zeros(0, np.int64), *far]), np.repeat(np.arange(len(far)), [len(x) for x in far])
        by = np.argsort(values, kind="stable")
        self.values, self.holder, self.n = values[by], holder[by], len(far)

    def counts(self, own: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """For runs i to j of ``own``, a matrix."""
        limit = max(1, (1 << 20) // max(1, self.n))
        for i in range(0, len(own), limit):
            part = own[i : i + limit]
            mine = np.concatenate([np.zeros(0, np.int64), *part])
            low = np.searchsorted(self.values, mine)
            m = np.searchsorted(self.values, mine, side="right") - low
            row = np.repeat(np.arange(len(part)), [len(x) for x in part]) * self.n
            total, ends = np.zeros(len(part) * self.n, np.int64), np.cumsum(m)
            a = 0
            while a < len(m):
                # Hits are counted in portions of a few million.
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << 22))))
                hits = self.holder[np.arange(int(m[a:b].sum())) + np.repeat(low[a:b] - (np.cumsum(m[a:b]) - m[a:b]), m[a:b])]
                total += np.bincount(np.repeat(row[a:b], m[a:b]) + hits, minlength=len(total))
                a = b
            yield i, i + len(part), total.reshape(len(part), self.n)


def _cells(batches: Iterator, arrays: bool) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, of batches sorted by it; arrays in the last column are taken as such if ``arrays``."""
    key, group = None, []
    for batch in batches:
        last = batch.column(batch.num_columns - 1)
        if arrays:
            flat, at = last.flatten().to_numpy(), last.offsets.to_numpy()
            ends = np.split(flat.astype(np.int64), (at - at[0])[1:-1])
        else:
            ends = last.to_pylist()
        for *x, end in zip(*[batch.column(c).to_pylist() for c in range(batch.num_columns - 1)], ends, strict=True):
            if x[0] != key:
                if group:
                    yield group
                key, group = x[0], []
            group.append((*x, end))
    if group:
        yield group


#: Sides of a cell that a member is on: both, only that which is compared with, only that which compares.
BOTH, FAR, OWN = 0, 1, 2


def _overlaps(groups: DataFrame, percent: int, k: int, block: int = BLOCK) -> DataFrame:
    """What is alike by its sketches among the members of each pivot (pivot, digest, root, n, sketch) that have two roots.

    A group falls into cells by size, in steps of the threshold: a member meets those of its own step and of the next.
    Cells of more than ``block`` members are cut on both sides, so that no task ever holds more than two blocks. In a
    cell, inverted lists of the sketches count the overlaps of all pairs at once. Where few are alike, their pairs are
    given (a, b); where many are, the cell's members (a: digest, b: root, cell, side).
    """
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    # The upper 32 bits keep the order; what falls together can only add to an overlap.
    short = F.transform("sketch", lambda v: (F.shiftright(v, 31) - F.lit(1 << 31)).cast("int"))
    both = groups.select("pivot", "digest", "root", "n", short.alias("short"), (F.abs(F.hash("digest")) % 65536).alias("_h"), F.explode(F.array(F.struct(step.alias("cell"), F.lit(BOTH).alias("side")), F.struct((step - 1).alias("cell"), F.lit(FAR).alias("side")))).alias("_c")).select("*", "_c.*")
    many = both.groupBy("pivot", "cell").agg(
        F.ceil(F.greatest(F.count("*") / block, F.sum("n") / SHINGLES)).cast("int").alias("_g"), F.min("root").alias("_low"), F.max("root").alias("_high"), F.min("side").alias("_own")
    )
    many = store(many.where((F.col("_low") != F.col("_high")) & (F.col("_own") == BOTH)).select("pivot", "cell", "_g"), "cells")
    here = both.join(many, ["pivot", "cell"])
    part, each = F.col("_h") % F.col("_g"), F.sequence(F.lit(0), F.col("_g") - 1)
    one = here.where("_g = 1").select("*", F.lit(0).cast("int").alias("r"), F.lit(0).cast("int").alias("s"))
    far = here.where("_g > 1").withColumn("side", F.lit(FAR)).select("*", F.explode(each).alias("r"), part.cast("int").alias("s"))
    own = here.where(f"_g > 1 AND side = {BOTH}").withColumn("side", F.lit(OWN)).select("*", part.cast("int").alias("r"), F.explode(each).alias("s"))
    names = ["cid", "side", "digest", "root", "n", "short"]
    placed = one.unionByName(far).unionByName(own).withColumn("cid", F.xxhash64("pivot", "cell", "r", "s")).select(*names)
    least = needed(percent / 100, k)

    def padded(sketches_: list[np.ndarray], beyond: int) -> np.ndarray:
        out = np.arange(k, dtype=np.int64) + np.zeros((len(sketches_), 1), np.int64) + (beyond << 40)
        for x, s in enumerate(sketches_):
            out[x, : len(s)] = s
        return out

    def compare(group: list[tuple]) -> list[tuple] | None:
        own, far = [x for x in group if x[1] != FAR], [x for x in group if x[1] != OWN]
        number: dict[bytes, int] = {}
        root_own, root_far = (np.asarray([number.setdefault(x[3], len(number)) for x in side], np.int64) for side in (own, far))
        if len(number) < 2 or not own or not far:
            return []
        n_own, n_far = np.asarray([x[4] for x in own])[:, None], np.asarray([x[4] for x in far])[None, :]
        wide_own, wide_far = padded([x[5] for x in own], 1), padded([x[5] for x in far], 2)
        out: list[tuple] = []
        for i, j, shared in Counter([x[5] for x in far]).counts([x[5] for x in own]):
            smaller, larger = np.minimum(n_own[i:j], n_far), np.maximum(n_own[i:j], n_far)
            x, y = np.nonzero((shared >= np.minimum(least, -(-smaller * percent // 100))) & (smaller * 100 >= larger * percent) & (root_own[i:j, None] != root_far[None, :]))
            for at in range(0, len(x), 1 << 12):
                p, q = x[at : at + (1 << 12)], y[at : at + (1 << 12)]
                merged = np.concatenate([wide_own[i + p], wide_far[q]], 1)
                merged.sort(axis=1)
                same = merged[:, 1:] == merged[:, :-1]
                union = (same & (np.arange(1, 2 * k) - np.cumsum(same, axis=1) < k)).sum(1)
                total = same.sum(1)
                whole = larger[p, q] <= k
                good = np.where(whole, total * 100 >= (n_own[i + p, 0] + n_far[0, q] - total) * percent, union >= least)
                for u, v in zip(p[good].tolist(), q[good].tolist(), strict=True):
                    d, e = own[i + u][2], far[v][2]
                    out.append((min(d, e), max(d, e), None, None))
                if len(out) > DENSE * len(group):
                    return None
        return out

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int32()]
        for group in _cells(batches, True):
            found = compare(group)
            if found is None:
                found = [(x[2], x[3], x[0], x[1]) for x in group]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=["a", "b", "cell", "side"])

    return placed.repartition("cid").sortWithinPartitions("cid").mapInArrow(run, "a binary, b binary, cell long, side int")


def _dense(docs: DataFrame, cells: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) in cells where many are alike (a: digest, b: root, cell, side), on the full sets: enough of them to join
    all roots that links join."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for group in _cells(batches, False):
            data = [np.frombuffer(x[4].encode(), np.uint8) for x in group]
            sets = [next(shingles(d, np.asarray([0, len(d)]), width)) for d in data]
            real = [(x, s.astype(np.int64)) for x, s in zip(group, sets, strict=True) if hashlib.md5(s.tobytes()).digest() == x[2]]
            own, far = [x for x in real if x[0][1] != FAR], [x for x in real if x[0][1] != OWN]
            if not own or not far:
                continue
            above: dict[bytes, bytes] = {}

            def top(x: bytes, above: dict[bytes, bytes] = above) -> bytes:
                while (y := above.get(x, x)) != x:
                    x = y
                return x

            sizes, out = np.asarray([len(s) for _, s in far])[None, :], []
            for i, j, shared in Counter([s for _, s in far]).counts([s for _, s in own]):
                either = np.asarray([len(s) for _, s in own[i:j]])[:, None] + sizes - shared
                for u, v in zip(*[z.tolist() for z in np.nonzero(100 * shared >= percent * either)], strict=True):
                    (x, _), (y, _) = own[i + u], far[v]
                    p, q = top(x[3]), top(y[3])
                    if p != q:
                        above[max(p, q)] = min(p, q)
                        out.append((x[2], y[2]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])

    texts = _texts(docs, cells.select(F.col("a").alias("digest")), classes)
    rows = cells.join(texts.withColumnRenamed("digest", "a"), "a").select("cell", "side", "a", "b", "text")
    return store(rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a binary, b binary"), "dense")


def _rooted(docs: DataFrame, width: int, percent: int, k: int, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """The ``sketches``, and by digest the root of its component and the least doc_id there."""
    rows = store(sketches(docs, width, k, whole), "sketches")
    classes = store(rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch")), "classes")
    roots = components(links(docs, classes, width, percent, k)).withColumnsRenamed({"node": "digest"})
    rooted = classes.select("digest", "doc_id").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows, store(rooted.join(least, "root").select("digest", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    Rows are linked if their sets of shingles of ``width`` words (A-Z in lower case; a text of fewer words is one
    shingle) have a Jaccard similarity of ``percent`` in 100 at least; component_id is the least doc_id that links
    lead to. A null or empty text, or one without words, is linked with nothing and is its own component. kept is true
    where doc_id is component_id; rows that repeat a doc_id within a component are kept alike. A null doc_id is never the
    least unless all are null. Other columns are left out; an empty table gives an empty one.
    """
    rows, of = _rooted(docs, width, percent, k)
    out = rows.select("doc_id", "n_shingles", "digest").join(of, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that of the least doc_id; see ``near_duplicates``.

    All columns stay. A row counts by doc_id and text: of rows that share the least doc_id the one of the least digest of
    its text stays, of rows that agree in both any one. Rows without words, and rows that are linked with nothing, stay
    whatever other rows have their doc_id.
    """
    rows, of = _rooted(docs, width, percent, K, True)
    each = store(rows.select("doc_id", "digest", "text_digest").join(of, "digest").groupBy("root", "doc_id", "text_digest").agg(F.count("*").alias("_n")), "near")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_digest")
    first = each.groupBy("root").agg(F.min(place).alias("_first"), F.sum("_n").alias("_all")).where("_all > 1").select("root", "_first")
    grouped = store(each.join(first, "root").select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_d"), place.eqNullSafe(F.col("_first")).alias("_kept"), "_n"), "grouped")
    keyed = docs.withColumn("_digest", text_digest(F.col("text")))

    def pick(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(keys, rows["doc_id"].eqNullSafe(keys["_id"]) & (rows["_digest"] == keys["_d"]), how)

    left = pick(keyed, _bounded(grouped.where("NOT _kept").select("_id", "_d")), "left_anti")
    twice = grouped.where("_kept AND _n > 1").select("_id", "_d")
    if not twice.isEmpty():
        twice = _bounded(twice)
        left = pick(left, twice, "left_anti").unionByName(pick(left, twice, "left_semi").dropDuplicates(["doc_id", "_digest"]))
    return left.select(*docs.columns)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), 3, 85)


QUERIES = {"op9_near_dedup": op9_near_dedup}
ORACLE: dict[str, str] = {}
