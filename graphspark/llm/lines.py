"""Line deduplication by winnowing over line hashes.

Of each window of ``LINES`` line hashes the least is a fingerprint, so a run of that many lines that occurs twice has a
fingerprint in common. Fingerprints that occur once end there. The others' positions are joined with what stands around
them: a match is extended both ways to whole windows, whose first occurrence is an aggregate with map-side combine, so
no list of positions is ever gathered; windows that overlap join into runs, and the later runs go. Where long passages
count as well, a window of fewer lines that has enough words is its own fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import mix, window_minima
from .common import hot_keys, read, salted_join, store, text_digest

#: Lines of the shortest run that counts as repeated.
LINES = 3
#: Words from which fewer lines are a run as well, where this is asked for.
WORDS = 50
#: What may stand around a line without making it another.
MARGIN = " \t\r"


def line_hashes(text: str) -> tuple[np.ndarray, list[int]]:
    """Hashes of the lines of ``text`` that are not blank, and which lines these are."""
    import xxhash

    lines = [x.strip(MARGIN) for x in text.split("\n")]
    where = [k for k, x in enumerate(lines) if x]
    return np.asarray([xxhash.xxh3_64_intdigest(lines[k].encode("utf-8", "surrogatepass")) for k in where], np.uint64), where


def long_windows(text: str, where: list[int], lines: int, words: int) -> list[tuple[int, int]]:
    """First line (of those not blank, from 0) and lines of each window of fewer than ``lines`` lines with ``words`` words."""
    every = text.split("\n")
    sums = np.concatenate([[0], np.cumsum([len(every[k].split()) for k in where])])
    return [(k, n) for n in range(1, lines) for k in np.flatnonzero(sums[n:] - sums[: max(0, len(sums) - n)] >= words).tolist()]


def fingerprints(docs: DataFrame, lines: int = LINES, words: int | None = None) -> DataFrame:
    """One row for each fingerprint of each row of ``docs``: doc_id, digest, gram, first, around.

    ``first`` is the first line (of those not blank, from 0) of the first window that chose it, ``around`` has the
    hashes of all lines of the windows that did. With ``words``, each shorter window of so many words is one as well.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["doc_id", "digest", "gram", "first", "around"]
        for batch in batches:
            owner, grams, firsts, around = [], [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                h, where = line_hashes(text) if text else (np.zeros(0, np.uint64), [])
                signed = h.astype(np.int64)
                for i, n in long_windows(text, where, lines, words) if words and where else []:
                    owner.append(k)
                    grams.append(mix(h[i : i + n] + np.uint64(n)).sum().astype(np.int64))
                    firsts.append(i)
                    around.append(signed[i : i + n])
                if len(h) < lines:
                    continue
                place = window_minima(h, lines)
                turn = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
                for i, j in zip(turn[:-1].tolist(), turn[1:].tolist(), strict=True):
                    owner.append(k)
                    grams.append(signed[place[i]])
                    firsts.append(i)
                    around.append(signed[i : j + lines - 1])
            index = pa.array(owner, pa.int64())
            columns = [batch.column(0).take(index), batch.column(1).take(index), pa.array(grams, pa.int64()), pa.array(firsts, pa.int32()), pa.array(around, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, digest binary, gram long, first int, around array<long>")


def repeated_windows(docs: DataFrame, lines: int = LINES, words: int | None = None) -> DataFrame:
    """doc_id, digest, starts and sizes: first lines and lines of those windows of each row that also begin earlier."""
    found = store(fingerprints(docs, lines, words), "fingerprints")
    again = store(found.groupBy("gram").agg(F.count("*").alias("_n")).where(F.col("_n") > 1), "again")
    steps = F.sequence(F.lit(0), F.greatest(F.size("around") - lines, F.lit(0)))
    extended = F.transform(steps, lambda j: F.struct((F.col("first") + j).alias("start"), F.slice("around", j + 1, lines).alias("window")))
    kept = salted_join(found, again.select("gram"), "gram", hot_keys(again, "gram", found.count()), ["doc_id", "digest", "first"])
    windows = store(kept.select("doc_id", "digest", F.explode(extended).alias("_w")).select("doc_id", "digest", "_w.*"), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "start")
    first = store(windows.groupBy("window").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where(F.col("_n") > 1), "first")
    hot = hot_keys(first, "window", windows.count())
    late = salted_join(windows, first.select("window", "_first"), "window", hot, ["doc_id", "digest", "start"]).where(place > F.col("_first"))
    spans = late.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set(F.struct("start", F.size("window").alias("size")))).alias("_s"))
    return spans.select("doc_id", "digest", F.col("_s.start").alias("starts"), F.col("_s.size").alias("sizes"))


def drop_repeats(text: str | None, starts: list[int] | None, sizes: list[int] | None) -> tuple[str | None, int, int, int]:
    """The text without the lines of the windows at ``starts`` of ``sizes`` lines; its lines that are not blank, those that go, their runs."""
    if text is None:
        return None, 0, 0, 0
    every = text.split("\n")
    where = [k for k, x in enumerate(every) if x.strip(MARGIN)]
    if starts is None or not len(starts):
        return text, len(where), 0, 0
    gone = np.zeros(len(where), bool)
    for s, n in zip(starts, sizes, strict=True):
        gone[s : s + n] = True
    out = {where[k] for k in np.flatnonzero(gone).tolist()}
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
    return "\n".join([x for k, x in enumerate(every) if k not in out]), len(where), len(out), runs


def dedup_lines(docs: DataFrame, lines: int = LINES, words: int | None = None) -> DataFrame:
    """``docs`` with repeated runs of lines removed from text, and n_lines, n_removed and n_runs, replacing such columns.

    A line goes if it is in a run of ``lines`` lines, or with ``words`` of fewer that have so many words, that also begins earlier: in a row of smaller doc_id (a null one
    is the greatest) or at an earlier line of the same row. Lines are compared without white space at their ends; blank
    lines neither count nor go. Runs are judged on the input and overlapping ones count. A null text stays null and has no
    lines; rows that agree in doc_id and text are one row and are treated alike. Other columns stay; an empty table
    gives an empty one.
    """
    late = store(repeated_windows(docs, lines, words), "late").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_d"), "starts", "sizes")

    @F.pandas_udf("text string, n_lines long, n_removed long, n_runs long")
    def rebuilt(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([drop_repeats(*x) for x in zip(texts, starts, sizes, strict=True)], columns=["text", "n_lines", "n_removed", "n_runs"])

    keyed = docs.withColumn("_digest", text_digest(F.col("text")))
    # The starts grow with the texts: both are always dealt by key, at every size alike.
    joined = keyed.join(late.hint("merge"), keyed["doc_id"].eqNullSafe(late["_id"]) & (keyed["_digest"] == late["_d"]), "left")
    # Not deterministic, as far as the optimizer knows: a filter on the outcome would else rebuild every text once more.
    out = joined.withColumn("_r", rebuilt.asNondeterministic()(F.col("text").cast("string"), F.col("starts"), F.col("sizes")))
    new = ("n_lines", "n_removed", "n_runs")
    kept = [F.col("_r.text").alias("text") if c == "text" else keyed[c] for c in docs.columns if c not in new]
    return out.select(*kept, *[F.col(f"_r.{c}").alias(c) for c in new])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", digest.alias("kept_sha256"))


QUERIES = {"op8_line_dedup": op8_line_dedup}
ORACLE = {
    "op8_line_dedup": """
        WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL),
        l AS (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS i FROM s),
        k AS (SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(13)) AS a, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
              FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
        w AS (SELECT doc_id, n, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY n)),
        r AS (SELECT doc_id, n, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, n) AS k FROM w WHERE c IS NOT NULL),
        g AS (SELECT DISTINCT doc_id, unnest(range(n, n + 3)) AS n FROM r WHERE k > 1),
        c AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (n - 1 <> before OR before IS NULL) AS n_runs
              FROM (SELECT doc_id, n, lag(n) OVER (PARTITION BY doc_id ORDER BY n) AS before FROM g) GROUP BY 1),
        t AS (SELECT doc_id, count(k.n) AS n_lines, string_agg(line, chr(10) ORDER BY i) FILTER (g.n IS NULL) AS kept
              FROM l LEFT JOIN k USING (doc_id, i) LEFT JOIN g USING (doc_id, n) GROUP BY 1)
        SELECT d.doc_id, CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(c.n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(t.kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id"""
}
