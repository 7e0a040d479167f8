"""Benchmark decontamination with DataFrame functions only.

The distinct windows of the benchmark are broadcast as a hash set, in blocks of a fixed size; each training text is
tokenised once and its window hashes exploded and probed; a hit is verified word by word. What comes back is one row a
document and one a hit, so a single narrow shuffle gathers the result; rows that agree are counted there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, store, text_digest

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a window; windows that are broadcast at once (about 200 bytes each).
N, BLOCK = 10, 200_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text whose letters keep their case.
CASED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text with A-Z in lower case; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """(_h, _size, _window, _items): each distinct window of ``n`` words, or whole shorter item, and its item ids."""
    w, size = F.col("_w"), F.size("_w")
    width = F.least(size, F.lit(n))
    starts = F.sequence(F.lit(1), size - width + 1)
    return (
        benchmark.select(F.col("item_id").cast("string").alias("_item"), words(F.col("text")).alias("_w"))
        .where((size > 0) & F.col("_item").isNotNull())
        .select("_item", F.explode_outer(F.transform(starts, lambda i: F.slice(w, i, width))).alias("_window"))
        .groupBy("_window").agg(F.collect_set("_item").alias("_items"))
        .select(F.xxhash64("_window").alias("_h"), F.size("_window").alias("_size"), "_window", "_items")
    )


def _window_hashes(w: Column, size: int) -> Column:
    """A struct (h, at, size) for each window of ``size`` words."""
    last = F.size(w) - size + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(w, i, F.lit(size))).alias("h"), i.alias("at"), F.lit(size).alias("size")))


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = N, block: int = BLOCK) -> DataFrame:
    """One row for each document: doc_id, _digest, n_words, n_rows, _hits (array of first word from 1, and words), items.

    A row of ``docs`` counts by doc_id and text: rows that agree in both are one here, and ``n_rows`` is how many they are. A null text has no words; a null
    item_id or an item without words hits nothing; an empty benchmark hits nothing.
    """
    windows = store(benchmark_windows(benchmark, n), "benchmark")
    sizes = {r[0]: r[1] for r in windows.groupBy("_size").count().collect()}  # one row for each size up to n
    blocks = max(1, math.ceil(sum(sizes.values()) / block))
    hashes = F.array(F.struct(F.lit(None).cast("long").alias("h"), F.lit(0).alias("at"), F.lit(0).alias("size")))
    for size in sorted(sizes):
        hashes = F.concat(hashes, _window_hashes(F.col("_w"), size))
    base = docs.select("doc_id", text_digest(F.col("text")).alias("_digest"), words(F.col("text")).alias("_w"))
    # The hashes are made in a projection of their own: the explode then runs in generated code, beside the probe, and
    # passes the words on by reference instead of copying them for each window. The arrays are never empty; a plain
    # explode would infer a filter on their size, in which the text is tokenised again for each window.
    probes = base.withColumn("_hashes", hashes).select("doc_id", "_digest", "_w", F.explode_outer("_hashes").alias("_p"))
    found = None
    for k in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("_window", F.lit("block")), F.lit(blocks)) == k) if blocks > 1 else windows
        # The key is the hash alone, a long; at most ``block`` windows of ``n`` words bound the broadcast.
        same = (F.col("_p.size") == F.col("_size")) & (F.slice("_w", F.greatest(F.col("_p.at"), F.lit(1)), F.col("_p.size")) == F.col("_window"))
        hit = probes.join(F.broadcast(own), F.col("_p.h") == F.col("_h"), "left").where(F.when(F.col("_p.at") == 0, F.lit(k == 0)).otherwise(F.col("_h").isNotNull() & same))
        hit = hit.select("doc_id", "_digest", F.when(F.col("_p.at") == 0, F.size("_w")).alias("_n"), F.when(F.col("_p.at") > 0, F.struct("_p.at", "_p.size")).alias("_hit"), "_items")
        found = hit if found is None else found.unionByName(hit)
    return found.groupBy("doc_id", "_digest").agg(
        F.max("_n").cast("long").alias("n_words"),
        F.count("_n").cast("int").alias("n_rows"),
        F.array_sort(F.collect_set("_hit")).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"),
    )


def _covered(hits: Column) -> Column:
    """How many words the sorted hits cover."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(1).alias("next"))
    return F.aggregate(
        hits, zero,
        lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["at"] + x["size"] - F.greatest(s["next"], x["at"]))).alias("n"), F.greatest(s["next"], x["at"] + x["size"]).alias("next")),
        lambda s: s["n"].cast("long"),
    )


def _runs(hits: Column) -> Column:
    """The sorted hits as runs (at, end) that do not touch; ends are exclusive."""

    def add(runs: Column, x: Column) -> Column:
        last, end = F.try_element_at(runs, F.lit(-1)), x["at"] + x["size"]
        longer = F.struct(last["at"].alias("at"), F.greatest(last["end"], end).alias("end"))
        return F.when((F.size(runs) > 0) & (x["at"] <= last["end"]), F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(F.struct(x["at"].alias("at"), end.alias("end")))))

    return F.aggregate(hits, F.array().cast("array<struct<at:int,end:int>>"), add)


def _once(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """``docs`` without the hit words: each run of them goes from the text, with what stands between its words.

    Documents that are left without a word go. Other columns stay as they are, n_chars included. Texts without a hit
    are not touched, and rows are matched to their hits by doc_id and text, nulls included.
    """
    hits = find_hits(docs, benchmark, n).where(F.size("_hits") > 0).select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_d"), "_hits", "n_words")
    keyed = docs.withColumn("_digest", text_digest(F.col("text")))
    joined = keyed.join(hits, keyed["doc_id"].eqNullSafe(hits["_id"]) & (keyed["_digest"] == hits["_d"]), "left")
    # Each step's arrays are made once a row: a lambda's argument is a value, where a column would be worked out again for
    # every element that refers to it. Work grows with the words and the runs, not with their product.
    cut = F.struct(F.regexp_extract_all("text", F.lit(CASED), F.lit(0)).alias("own"), F.split("text", CASED, -1).alias("gaps"), _runs(F.col("_hits")).alias("runs"))

    def paired(m: Column) -> Column:
        # Each word with what follows it.
        return F.struct(F.zip_with(m["own"], F.slice(m["gaps"], F.lit(2), F.size(m["own"])), lambda x, y: F.concat(x, y)).alias("words"), m["gaps"].alias("gaps"), m["runs"].alias("runs"))

    def rest(m: Column) -> Column:
        def part(run: Column, k: Column) -> Column:
            # The words since the run before, and what follows the last word of this one.
            since = F.when(k == 0, F.lit(1)).otherwise(F.get(m["runs"], k - 1)["end"])
            return F.concat(F.array_join(F.slice(m["words"], since, run["at"] - since), ""), F.get(m["gaps"], run["end"] - 1))

        last = F.try_element_at(m["runs"], F.lit(-1))["end"]
        return F.concat(F.get(m["gaps"], F.lit(0)), F.array_join(F.transform(m["runs"], part), ""), F.array_join(F.slice(m["words"], last, F.size(m["words"]) - last + 1), ""))

    hit = F.col("_hits").isNotNull()
    cleaned = joined.where(~hit | (_covered(F.col("_hits")) < F.col("n_words"))).withColumn("_text", F.when(hit, _once(_once(cut, paired), rest)).otherwise(F.col("text")))
    return cleaned.select(*[F.col("_text").alias("text") if c == "text" else keyed[c] for c in docs.columns])


def report(docs: DataFrame, benchmark: DataFrame, n: int = N) -> DataFrame:
    """One row for each row of ``docs``, repeated ones included: how many of its words are hit, and by which items."""
    found = find_hits(docs, benchmark, n)
    n_hit = _covered(F.col("_hits"))
    each = found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "n_rows",
    )
    return each.withColumn("n_rows", F.explode(F.array_repeat(F.lit(1), F.col("n_rows")))).drop("n_rows")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op4_decontamination": op4_decontamination}
ORACLE = {
    "op4_decontamination": """
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS k, least(len(w), 10) AS n
               FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        h AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw USING (k)),
        p AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
        it AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM h GROUP BY 1)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256, coalesce(p.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""
}
