"""Removal of repeated byte strings on Burrows-Wheeler transforms.

A string of ``LENGTH`` bytes that occurs twice chooses the same anchor in both places: the gram of least hash inside it.
So the text falls into anchors with the strings that chose them, and only anchors whose gram stands in several contexts
have anything to compare. Their contexts are gathered by gram, suffixes are sorted, and on the transform a breadth-first
backward extension finds the borders between suffixes by increasing common prefix, up to ``LENGTH``; suffixes with no
border between them begin with the same string. Texts travel as compressed chunks; hashes, codes and masks as arrays.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import RUN, between, gram_hashes, mix, prefix_hashes, runs, text_buffer, window_minima
from .common import read, store

#: Bytes of a string that must not repeat, and of the gram that anchors it.
LENGTH, GRAM = 100, 40
#: Bytes of text of one chunk; of text for each bucket of anchors; of one transform.
CHUNK, BUCKET, BLOCK = 1 << 21, 1 << 24, 2_000_000
#: What is known of an anchor's strings: nothing repeats; all occur earlier; to be compared; to be compared one by one.
NEW, REPEATED, COMPARE, SINGLE = 0, 1, 2, 3
#: Follows each piece of a transform's text; no byte of UTF-8.
END = 255


def _pack(x: np.ndarray | bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x if isinstance(x, bytes) else x.tobytes())


def _unpack(x: bytes, kind: str | None = None):
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(x)
    return np.frombuffer(raw, kind) if kind else raw


def chunks(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """The rows of ``docs`` (doc_id, text), many to a chunk: chunk, ids, sizes, n_bytes, body. Written to the shared folder."""

    def gather(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ids, sizes = batch.column(0).to_pylist(), np.diff(offsets)
            for a, b in runs(sizes, size):
                body = data[offsets[a] : offsets[b]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[a:b]], pa.list_(pa.int64())), pa.array([sizes[a:b].tolist()], pa.list_(pa.int64())), pa.array([len(body)], pa.int64()), pa.array([_pack(body)], pa.binary())],
                    names=["ids", "sizes", "n_bytes", "body"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gathered = rows.mapInArrow(gather, "ids array<long>, sizes array<long>, n_bytes long, body binary")
    return store(gathered.select(F.monotonically_increasing_id().alias("chunk"), "*"), "chunks", "none")


class Anchors:
    """The anchors of a chunk: gram hash, hash of all that chose it, first string, how many strings, row."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, length: int, gram: int):
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        grams, contexts, firsts, counts = [], [], [], []
        for a, b in runs(sizes, RUN):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            n = len(part) - length + 1
            if n <= 0:
                continue
            prefix = prefix_hashes(part)
            h = gram_hashes(prefix, gram)
            place = window_minima(h, length - gram + 1)
            for end in own[1:-1].tolist():
                place[max(0, end - length + 1) : end] = -1
            small = np.flatnonzero(np.diff(own) < length)
            for k in small.tolist():
                place[max(0, own[k]) : own[k + 1]] = -1
            turn = np.flatnonzero(place[1:] != place[:-1]) + 1
            turn = np.concatenate([[0], turn, [n]])
            first, count = turn[:-1], np.diff(turn)
            real = place[first] >= 0
            first, count = first[real], count[real]
            at = place[first]
            grams.append(h[at])
            contexts.append(mix(between(prefix, first, first + count + length - 1) + (at - first).astype(np.uint64)))
            firsts.append(first + offsets[a])
            counts.append(count)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.gram, self.context = join(grams, np.uint64), join(contexts, np.uint64)
        self.first, self.count = join(firsts, np.int64), join(counts, np.int64)
        self.row = np.searchsorted(offsets, self.first, side="right") - 1
        self.start = self.first - offsets[self.row]

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The anchors' order by bucket, the buckets that have any, and where each begins in that order."""
        bucket = (self.gram % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, at = np.unique(bucket[order], return_index=True)
        return order, found, np.concatenate([at, [len(order)]])


def _opened(batch, k: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Anchors]:
    """Bytes, sizes and ids (null as the greatest) of a chunk row, and its anchors."""
    column = {n: batch.column(n)[k] for n in ("ids", "sizes", "body")}
    data = _unpack(column["body"].as_py(), "u1")
    sizes = column["sizes"].values.to_numpy()
    ids = column["ids"].values.fill_null(np.iinfo(np.int64).max).to_numpy()
    return data, sizes, ids, Anchors(data, sizes, length, gram)


def _rows(names: list[str], kinds: list, rows: list[tuple]):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _codes(found: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """What is known of each chunk's anchors from their hashes: chunk, bucket, codes."""

    def spread(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                _, _, ids, a = _opened(batch, k, length, gram)
                order, found, at = a.by_bucket(buckets)
                chunk = batch.column("chunk")[k].as_py()
                doc = ids[a.row]
                rows = []
                for bucket, i, j in zip(found.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    own = order[i:j]
                    rows.append((bucket, chunk, a.gram[own].tobytes(), a.context[own].tobytes(), _pack(np.diff(doc[own], prepend=0))))
                if rows:
                    yield _rows(["bucket", "chunk", "grams", "contexts", "docs"], [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()], rows)

    def judge(table):
        import pyarrow as pa

        columns = {n: table.column(n).to_pylist() for n in table.column_names}
        turn = np.argsort(columns["chunk"], kind="stable")
        grams = [np.frombuffer(columns["grams"][k], np.uint64) for k in turn]
        sizes = [len(x) for x in grams]
        gram_ = np.concatenate(grams)
        context = np.concatenate([np.frombuffer(columns["contexts"][k], np.uint64) for k in turn])
        doc = np.concatenate([np.cumsum(_unpack(columns["docs"][k], "i8")) for k in turn])
        codes = np.zeros(len(gram_), np.uint8)
        # Only grams that occur twice go on.
        by = np.argsort(gram_)
        same = gram_[by[1:]] == gram_[by[:-1]]
        again = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        if len(again):
            again = np.sort(again)
            g, c, d = gram_[again], context[again], doc[again]
            by = np.lexsort((np.arange(len(again)), d, c, g))
            g, c = g[by], c[by]
            new_gram = np.concatenate([[True], g[1:] != g[:-1]])
            new_context = new_gram | np.concatenate([[True], c[1:] != c[:-1]])
            group = np.cumsum(new_gram) - 1
            contexts = np.bincount(group, weights=new_context)[group]
            code = np.where(new_context, np.where(contexts == 1, NEW, np.where(contexts * (2 * length - gram) > BLOCK, SINGLE, COMPARE)), REPEATED)
            codes[again[by]] = code
        ends = np.cumsum(sizes)
        rows = [(columns["chunk"][k], columns["bucket"][k], _pack(codes[e - s : e])) for k, s, e in zip(turn.tolist(), sizes, ends.tolist(), strict=True)]
        return pa.Table.from_batches([_rows(["chunk", "bucket", "codes"], [pa.int64(), pa.int32(), pa.binary()], rows)])

    spread_out = found.select("chunk", "ids", "sizes", "body").mapInArrow(spread, "bucket int, chunk long, grams binary, contexts binary, docs binary")
    return spread_out.groupBy("bucket").applyInArrow(judge, "chunk long, bucket int, codes binary")


def _coded(batch, k: int, a: Anchors, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of a chunk's anchors, their buckets, and the order by bucket."""
    order, found, _ = a.by_bucket(buckets)
    given = {x["bucket"]: x["codes"] for x in batch.column("codes")[k].as_py() or ()}
    codes = np.zeros(len(order), np.uint8)
    if len(order):
        codes[order] = np.concatenate([_unpack(given[b], "u1") for b in found.tolist()])
    return codes, (a.gram % np.uint64(buckets)).astype(np.int64), order


def _pieces(data: np.ndarray, ids: np.ndarray, a: Anchors, codes: np.ndarray, buckets: int, length: int) -> tuple[np.ndarray, ...]:
    """What is to be compared, in order: bucket, key, anchor, first string from the anchor's first, how many strings."""
    whole, single = np.flatnonzero(codes == COMPARE), np.flatnonzero(codes == SINGLE)
    anchor = np.concatenate([whole, np.repeat(single, a.count[single])])
    skip = np.concatenate([np.zeros(len(whole), np.int64), np.arange(int(a.count[single].sum())) - np.repeat(np.cumsum(a.count[single]) - a.count[single], a.count[single])])
    count = np.concatenate([a.count[whole], np.ones(len(skip) - len(whole), np.int64)])
    key = a.gram[anchor]
    if len(single):
        at = (a.first[anchor] + skip)[len(whole) :]
        key = np.concatenate([key[: len(whole)], np.asarray([int.from_bytes(hashlib.blake2b(data[p : p + length].tobytes(), digest_size=8).digest(), "little") for p in at.tolist()], np.uint64)])
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return bucket[order], key[order], anchor[order], skip[order], count[order]


def sorted_rotations(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the rotations of ``codes`` (at most 2^21 bytes) in order of their first bytes, ``depth`` at least."""
    n, bits, shift = len(codes), np.uint64(21), np.uint64(42)
    index, low = np.arange(n, dtype=np.uint64), np.uint64((1 << 21) - 1)
    wide = np.concatenate([codes, np.resize(codes, 8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(5):
        key = (key << np.uint64(8)) | wide[j : j + n]
    done = 5
    packed = (key << bits) | index
    while True:
        packed.sort()
        order, head = (packed & low).astype(np.int64), packed >> bits
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[False], head[1:] != head[:-1]]), dtype=np.uint64)
        if done >= depth or int(rank[order[-1]]) == n - 1:
            return order
        packed = (rank << shift) | (np.roll(rank, -(done % n)) << bits) | index
        done *= 2


def borders(codes: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Where, in the sorted rotations, a common prefix of less than ``depth`` begins anew; by increasing prefix.

    The transform gives, for a place i, the place of the rotation that is one byte longer to the left. Intervals of one
    string are extended to the left, all of a level at once: the borders that they show are those of common prefixes as
    long as the level, and an interval whose border is known already is not followed.
    """
    n = len(codes)
    bwt = codes[order - 1]
    by_char = np.argsort(bwt, kind="stable").astype(np.int32)
    forward = np.empty(n, np.int32)
    forward[by_char] = np.arange(n, dtype=np.int32)
    # Next and previous place of the same byte in the transform.
    sorted_bwt = bwt[by_char]
    alike = sorted_bwt[1:] == sorted_bwt[:-1]
    after, before = np.full(n, n, np.int32), np.full(n, -1, np.int32)
    after[by_char[:-1][alike]] = by_char[1:][alike]
    before[by_char[1:][alike]] = by_char[:-1][alike]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.zeros(1, np.int32), np.full(1, n, np.int32)
    for _ in range(depth):
        size = high - low
        lone = size == 1
        many_low, many_high, size = low[~lone], high[~lone], size[~lone]
        total = int(size.sum())
        at = np.arange(total, dtype=np.int32) + np.repeat(many_low - (np.cumsum(size) - size).astype(np.int32), size)
        first = at[before[at] < np.repeat(many_low, size)]
        last = at[after[at] >= np.repeat(many_high, size)]
        single = forward[low[lone]]
        new_low, new_high = np.concatenate([forward[first], single]), np.concatenate([forward[last], single]) + np.int32(1)
        new_low.sort()
        new_high.sort()
        fresh = ~known[new_high]
        known[new_high] = True
        low, high = new_low[fresh], new_high[fresh]
        if not len(low):
            break
    return known


def repeated(texts: list[bytes], counts: list[int], ranks: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """By text, a mask of its first ``counts`` starts: bit k, if the string of ``length`` bytes from k also begins in
    another text with a lesser (rank, start + k)."""
    sizes = np.asarray([len(t) + 1 for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    codes = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    order = sorted_rotations(codes, length)
    group_at = np.empty(len(codes), np.int64)
    group_at[order] = np.cumsum(borders(codes, order, length)[:-1])
    many = np.asarray(counts, np.int64)
    owner = np.repeat(np.arange(len(texts)), many)
    skip = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    group = group_at[begins[owner] + skip]
    when = (ranks[owner].astype(np.int64) << 32) + starts[owner] + skip
    least = np.full(int(group.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, when)
    late = when > least[group]
    masks = np.zeros(len(texts), np.uint64)
    np.bitwise_or.at(masks, owner[late], np.uint64(1) << skip[late].astype(np.uint64))
    return masks


def _compare(found: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Masks of the strings that are to be compared: chunk, bucket, masks."""
    names = ["bucket", "chunk", "keys", "docs", "starts", "counts", "body"]

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                data, _, ids, a = _opened(batch, k, length, gram)
                codes, _, _ = _coded(batch, k, a, buckets)
                bucket, key, anchor, skip, count = _pieces(data, ids, a, codes, buckets, length)
                if not len(bucket):
                    continue
                chunk, raw = batch.column("chunk")[k].as_py(), data.tobytes()
                begin, doc, start = a.first[anchor] + skip, ids[a.row[anchor]], a.start[anchor] + skip
                own, at = np.unique(bucket, return_index=True)
                rows = []
                for b, i, j in zip(own.tolist(), at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True):
                    body = b"".join([raw[p : p + n + length - 1] for p, n in zip(begin[i:j].tolist(), count[i:j].tolist(), strict=True)])
                    rows.append((b, chunk, key[i:j].tobytes(), _pack(doc[i:j]), _pack(start[i:j]), _pack(count[i:j]), _pack(body)))
                yield _rows(names, [pa.int32(), pa.int64(), *[pa.binary()] * 5], rows)

    def judge(table):
        import pyarrow as pa

        columns = {n: table.column(n).to_pylist() for n in names}
        turn = sorted(range(table.num_rows), key=columns["chunk"].__getitem__)
        keys = np.concatenate([np.frombuffer(columns["keys"][k], np.uint64) for k in turn])
        docs, starts, counts = (np.concatenate([_unpack(columns[n][k], "i8") for k in turn]) for n in ("docs", "starts", "counts"))
        owner = np.repeat(np.arange(len(turn)), [len(columns["keys"][k]) // 8 for k in turn])
        body = b"".join([_unpack(columns["body"][k]) for k in turn])
        ends = np.cumsum(counts + length - 1)
        texts = [body[e - n : e] for e, n in zip(ends.tolist(), (counts + length - 1).tolist(), strict=True)]
        # One rank for each row of a document, by id and then chunk.
        rank = np.unique(np.stack([docs, owner], 1), axis=0, return_inverse=True)[1].reshape(-1)
        masks = np.zeros(len(texts), np.uint64)
        # Copies of one piece: all but the first are repeated as a whole.
        by = np.lexsort((starts, rank))
        seen: dict[bytes, int] = {}
        kept = []
        for k in by.tolist():
            if texts[k] in seen:
                masks[k] = (1 << int(counts[k])) - 1
            else:
                seen[texts[k]] = k
                kept.append(k)
        kept = np.asarray(kept, np.int64)
        kept = kept[np.argsort(keys[kept], kind="stable")]
        fresh = np.concatenate([[True], keys[kept][1:] != keys[kept][:-1]])
        heads = np.flatnonzero(fresh)
        sizes = np.add.reduceat(counts[kept] + length, heads)
        for i, j in runs(sizes, BLOCK):
            own = kept[heads[i] : heads[j] if j < len(heads) else len(kept)]
            if len(own) > 1:
                masks[own] = repeated([texts[k] for k in own.tolist()], counts[own].tolist(), rank[own], starts[own], length)
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
        rows = [(columns["chunk"][turn[k]], columns["bucket"][turn[k]], masks[i:j].tobytes()) for k, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))]
        return pa.Table.from_batches([_rows(["chunk", "bucket", "masks"], [pa.int64(), pa.int32(), pa.binary()], rows)])

    sent = found.select("chunk", "ids", "sizes", "body", "codes").mapInArrow(send, "bucket int, chunk long, keys binary, docs binary, starts binary, counts binary, body binary")
    return sent.groupBy("bucket").applyInArrow(judge, "chunk long, bucket int, masks binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = True) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) without the bytes that a repeated string covers.

    A byte goes if a string of ``length`` bytes that covers it also begins earlier: in a row of smaller doc_id (a null
    one is the greatest), in another row of the same doc_id that was read before, or in the same row at an earlier
    start. Strings are judged on the input; overlapping ones count; they never cross rows. A null text is empty.
    Columns: doc_id (long), n_bytes, n_removed, n_spans, kept_sha256, and kept (binary; null unless ``keep_text``), as
    what is left need not be UTF-8. Other columns are left out; an empty table gives an empty one.
    """
    if length - gram + 1 > 64 or gram > length:
        raise ValueError("a gram must be at most 63 bytes shorter than the string")
    found = chunks(docs)
    total = found.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(4, math.ceil(total / BUCKET))
    codes = store(_codes(found, buckets, length, gram), "codes")
    listed = codes.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "codes")).alias("codes"))
    coded = found.join(listed, "chunk", "left")
    masks = store(_compare(coded, buckets, length, gram), "masks")
    masked = masks.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "masks")).alias("masks"))

    def finish(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                data, sizes, ids, a = _opened(batch, k, length, gram)
                codes, _, _ = _coded(batch, k, a, buckets)
                change = np.zeros(len(data) + 1, np.int32)
                late = np.flatnonzero(codes == REPEATED)
                np.add.at(change, a.first[late], 1)
                np.add.at(change, a.first[late] + a.count[late] + length - 1, -1)
                bucket, _, anchor, skip, count = _pieces(data, ids, a, codes, buckets, length)
                if len(bucket):
                    given = {x["bucket"]: x["masks"] for x in batch.column("masks")[k].as_py()}
                    own = np.concatenate([np.frombuffer(given[b], np.uint64) for b in np.unique(bucket).tolist()])
                    for bit in range(int(count.max())):
                        hit = np.flatnonzero((own >> np.uint64(bit)) & np.uint64(1))
                        at = a.first[anchor[hit]] + skip[hit] + bit
                        np.add.at(change, at, 1)
                        np.add.at(change, at + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                ends = np.cumsum(sizes)
                rows, doc_ids = [], batch.column("ids")[k].as_py()
                left = data[~gone].tobytes()
                sums = np.concatenate([[0], np.cumsum(gone)])
                begins = gone & ~np.concatenate([[False], gone[:-1]])
                begins[(ends - sizes)[sizes > 0]] = gone[(ends - sizes)[sizes > 0]]
                spans = np.concatenate([[0], np.cumsum(begins)])
                for doc_id, e, n in zip(doc_ids, ends.tolist(), sizes.tolist(), strict=True):
                    s = e - n
                    removed = int(sums[e] - sums[s])
                    kept = left[s - int(sums[s]) : e - int(sums[e])]
                    rows.append((doc_id, n, removed, int(spans[e] - spans[s]), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                if rows:
                    yield _rows(names, kinds, rows)

    everything = coded.join(masked, "chunk", "left").select("chunk", "ids", "sizes", "body", "codes", "masks")
    return everything.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"), keep_text=False).drop("kept")


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
ORACLE: dict[str, str] = {}
