"""Language identification by interpolated Kneser-Ney character models.

One model for each language is fitted on a bounded sample of labelled rows. The n-grams of all languages are kept, by
order, in one sorted hash array, beside it a row of log-probabilities with a column for each language in which the
interpolation is already worked out; contexts have their back-off weights likewise. A text gets the language of lowest
cross-entropy a character, and is rejected where that entropy lies beyond what rows show that were not trained on: a
calibration part of the sample, or, of a language with few rows, each row under a model of the others.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import bound_batches, read

#: Longest n-gram; labelled rows of a language that a model may learn from, the characters that are read of one, and the bytes of all.
ORDER, SAMPLE, SAMPLE_BYTES, SAMPLE_TOTAL = 5, 400, 1 << 19, 1 << 19
#: Rows of the sample that calibrate instead of train: one in so many. Standard deviations beyond which a text is rejected.
CALIBRATE, BEYOND = 4, 6.0
#: Rows up to which a language trains on all of them and calibrates on folds, how many folds, and the rows below which
#: it rejects nothing.
FEW, FOLDS, LEAST = 100, 8, 4
#: Characters that are scored at once, and for how many characters at most a text counts as evidence in its score.
CHUNK, EVIDENCE = 1 << 18, 40
UNKNOWN = "und"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def prepare(text: str) -> str:
    return " ".join(text.lower().split())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, ORDER - 1 spaces before each, and where each text's first character is."""
    pad = " " * (ORDER - 1)
    joined = "".join([pad + t for t in texts])
    lengths = np.asarray([len(t) + ORDER - 1 for t in texts], dtype=np.int64)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), np.concatenate([[0], np.cumsum(lengths)])[:-1] + ORDER - 1


_RNG = np.random.RandomState(7)
_ODD = [np.uint64(int(x) | 1) for x in _RNG.randint(1 << 40, 1 << 62, size=ORDER, dtype=np.int64)]


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """By order from 1: the hash of the n-gram that ends at each place (of what is there, near the start)."""
    with np.errstate(over="ignore"):
        c = codes.astype(np.uint64) + np.uint64(1)
        c = (c ^ (c << np.uint64(17))) * np.uint64(0x9E3779B97F4A7C15)
        c ^= c >> np.uint64(29)
        total, out = np.zeros(len(c), np.uint64), []
        for k in range(ORDER):
            total = total.copy()
            total[k:] += c[: len(c) - k] * _ODD[k]
            out.append(total)
    return out


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


@dataclass
class Model:
    """grams[n], probs[n]: sorted hashes of n-grams and their log-probabilities by language; contexts[n], backs[n]:
    sorted hashes of (n - 1)-character contexts and their log back-off weights; floor: log-probability of a new character.
    """

    languages: list[str]
    grams: list[np.ndarray]
    probs: list[np.ndarray]
    contexts: list[np.ndarray]
    backs: list[np.ndarray]
    floor: np.ndarray
    limits: np.ndarray
    spread: float

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Nats a character under each language, a row for each (non-empty) text."""
        codes, starts = _codes(texts)
        hashes = _hashes(codes)
        ends = np.concatenate([starts[1:] - (ORDER - 1), [len(codes)]])
        logs = np.zeros((len(codes), len(self.languages)), np.float32)
        left = np.arange(len(codes))
        for n in range(ORDER, 0, -1):
            at, hit = _find(self.grams[n], hashes[n - 1][left])
            logs[left[hit]] += self.probs[n][at[hit]]
            left = left[~hit]
            if not len(left):
                break
            if n > 1:
                at, hit = _find(self.contexts[n], hashes[n - 2][np.maximum(left - 1, 0)])
                logs[left[hit]] += self.backs[n][at[hit]]
        logs[left] += self.floor
        sums = np.add.reduceat(logs.astype(np.float64), np.stack([starts, ends], 1).ravel()[:-1] if ends[-1] == len(codes) else np.stack([starts, ends], 1).ravel(), axis=0)[::2]
        return -sums / (ends - starts)[:, None]

    def score(self, texts: list[str | None]) -> pd.DataFrame:
        """language, score, entropy and rejected of each text."""
        n = len(texts)
        languages, scores, entropy, rejected = [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        for run in self._runs([(k, prepare(t)) for k, t in enumerate(texts) if t and has_letter(t)] if self.languages else []):
            parts = [(k, t[a : a + CHUNK]) for k, t in run for a in range(0, len(t), CHUNK)]
            each = self.entropies([t for _, t in parts])
            for k in dict.fromkeys(k for k, _ in parts):
                own = [j for j, (i, _) in enumerate(parts) if i == k]
                sizes = np.asarray([len(parts[j][1]) for j in own], float)
                e, size = (each[own] * sizes[:, None]).sum(0) / sizes.sum(), sizes.sum()
                best = int(e.argmin())
                languages[k], entropy[k] = self.languages[best], e[best]
                scores[k] = 1 / np.exp(-(e - e[best]) * min(size, EVIDENCE)).sum()
                rejected[k] = e[best] > self.limits[best] + self.spread / math.sqrt(size)
        return pd.DataFrame({"language": languages, "score": scores, "entropy": entropy, "rejected": rejected})

    @staticmethod
    def _runs(items: list[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
        run, size = [], 0
        for k, t in items:
            run.append((k, t))
            size += len(t)
            if size >= CHUNK:
                yield run
                run, size = [], 0
        if run:
            yield run


def train(samples: dict[str, list[str]]) -> Model:
    """A model of each language of ``samples`` (language to texts); languages without a text that has a letter are left out."""
    kept = {x: [p for t in texts if t and has_letter(t) and (p := prepare(t))] for x, texts in samples.items()}
    languages = sorted(x for x in kept if kept[x])
    if not languages:
        return Model([], [], [], [], [], np.zeros(0), np.zeros(0), 0.0)
    few = [x for x in languages if len(kept[x]) <= FEW]
    model = _fit({x: [t for k, t in enumerate(kept[x]) if x in few or k % CALIBRATE] for x in languages})
    held = {x: (texts := [t[:CHUNK] for k, t in enumerate(kept[x]) if k % CALIBRATE == 0], model.entropies(texts).min(1)) for x in languages if x not in few}
    for x in few:
        texts = [t[:CHUNK] for t in kept[x]]
        if len(texts) >= LEAST:
            e = np.zeros(len(texts))
            for j in range(min(FOLDS, len(texts))):
                own = [t for k, t in enumerate(kept[x]) if k % FOLDS != j]
                e[j::FOLDS] = _fit({x: own}, len(model.grams[1]) + 1).entropies(texts[j::FOLDS])[:, 0]
            held[x] = texts, e
    model.limits, model.spread = _calibrate(languages, held)
    _give_back()
    return model


def _give_back() -> None:
    """Return the memory of what is no longer held to the system, where the C library can; the counts of training are many
    times the model."""
    import ctypes

    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _fit(fit: dict[str, list[str]], alphabet: int | None = None) -> Model:
    """The n-grams and probabilities of a model, without limits; ``alphabet``: its characters and one more, if other texts add any."""
    languages = list(fit)
    codes, langs, first = [], [], []
    for k, x in enumerate(languages):
        c, s = _codes(fit[x])
        inside = np.ones(len(c), bool)
        for j in range(1, ORDER):
            inside[s - j] = False
        codes.append(c)
        langs.append(np.full(len(c), k))
        first.append(inside)
    code, lang, inside = np.concatenate(codes), np.concatenate(langs), np.concatenate(first)
    hashes, many = _hashes(code), len(languages)
    where = np.flatnonzero(inside)
    model = Model(languages, [np.zeros(0)], [np.zeros(0)], [np.zeros(0)], [np.zeros(0)], np.zeros(0), np.zeros(0), 0.0)
    # counts[n]: by n-gram of the union and language; at the top order how often, below it after how many characters.
    grams, places, counts = [None] * (ORDER + 1), [None] * (ORDER + 1), [None] * (ORDER + 1)
    for n in range(ORDER, 0, -1):
        grams[n], at, inverse = np.unique(hashes[n - 1][where], return_index=True, return_inverse=True)
        places[n] = where[at]
        c = np.zeros((len(grams[n]), many))
        if n == ORDER:
            np.add.at(c, (inverse, lang[where]), 1)
        else:
            # One for each longer n-gram of the language that ends in this one.
            j, _ = _find(grams[n], hashes[n - 1][places[n + 1]])
            np.add.at(c, j, seen[n + 1])
        counts[n] = c
        if n == ORDER:
            seen = {n: (c > 0).astype(float)}
        else:
            seen[n] = (c > 0).astype(float)
    alphabet = alphabet or len(grams[1]) + 1
    lower = np.full((1, many), 1.0 / alphabet)
    for n in range(1, ORDER + 1):
        c = counts[n]
        ones, twos = (c == 1).sum(0), (c == 2).sum(0)
        discount = np.clip(np.where(ones + 2 * twos > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.1, 0.95)
        context = hashes[n - 2][np.maximum(places[n] - 1, 0)] if n > 1 else np.zeros(len(grams[1]), np.uint64)
        contexts, inverse = np.unique(context, return_inverse=True)
        total, kinds = np.zeros((len(contexts), many)), np.zeros((len(contexts), many))
        np.add.at(total, inverse, c)
        np.add.at(kinds, inverse, c > 0)
        back = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if n > 1:
            j, _ = _find(grams[n - 1], hashes[n - 2][places[n]])
            below = lower[j]
        else:
            below = lower
        p = np.maximum(c - discount, 0) / np.maximum(total[inverse], 1) + back[inverse] * below
        model.grams.append(grams[n])
        model.probs.append(np.log(p).astype(np.float32))
        model.contexts.append(contexts)
        model.backs.append(np.log(back).astype(np.float32))
        if n == 1:
            model.floor = (np.log(back[0]) + math.log(1.0 / alphabet)).astype(np.float32)
        lower = p
    return model


def _calibrate(languages: list[str], held: dict[str, tuple[list[str], np.ndarray]]) -> tuple[np.ndarray, float]:
    """By language, the entropy beyond which a long text is rejected, and how much a short one may exceed it.

    ``held`` has texts that were not trained on and their entropies; a language that it lacks rejects nothing.
    """
    limits, spreads = [], [0.0]
    for x in languages:
        if x not in held:
            limits.append(np.inf)
            continue
        texts, e = held[x]
        size = np.asarray([len(t) for t in texts], float)
        # The greatest entropy of the calibration rows, and a margin of their own scatter: labelled rows are to stay.
        limits.append(e.max() + BEYOND * 0.1 * e.std() + 0.2)
        spreads.append(float(np.median(np.abs(e - np.median(e)) * np.sqrt(size))))
    return np.asarray(limits), BEYOND * max(spreads)


def sample_labelled(docs: DataFrame, most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES, total: int = SAMPLE_TOTAL) -> dict[str, list[str]]:
    """Up to ``most`` texts of each language: those of the least hash of doc_id, their fronts where they are long.

    If they come to more than ``total`` bytes, the longest are cut to one size at which they do not, so that no text
    takes the place of others. A count by language gives the share of hashes that holds about twice as many; only these
    rows are ranked.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 1))
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1 << 30, math.ceil((1 << 30) * 2 * most / n) + 1))]), F.col("lang"))
    few = labelled.where(part <= share).select("lang", F.substring("text", 1, most_bytes).alias("text"), part.alias("_part"))
    by_hash = W.partitionBy("lang").orderBy("_part", "text")
    ranked = few.withColumn("_n", F.row_number().over(by_hash)).where(F.col("_n") <= most)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    by_size, every = W.partitionBy("lang").orderBy("_size", "_part", "text"), W.partitionBy("lang")
    before = F.coalesce(F.sum("_size").over(by_size.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # From the shortest on, each text may take an even part of what is left; the first that is longer sets the size.
    even = (F.lit(total) - before) / (F.count("*").over(every) - F.row_number().over(by_size) + 1)
    ranked = ranked.withColumn("_size", size).withColumn("_even", even).withColumn("_level", F.max(F.when(F.col("_size") > F.col("_even"), F.col("_even"))).over(every))
    front = F.col("text").substr(F.lit(1), F.floor(F.col("_level") * F.length("text") / F.col("_size")).cast("int"))
    ranked = ranked.withColumn("text", F.when(F.col("_size") > F.col("_level"), front).otherwise(F.col("text")))
    out: dict[str, list[str]] = {}
    for lang, text in sorted((r[0], r[1]) for r in ranked.select("lang", "text").collect()):  # ``most`` rows and about ``total`` bytes a language
        out.setdefault(lang, []).append(text)
    return {k: sorted(v, key=lambda t: zlib.crc32(t.encode())) for k, v in out.items()}


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1), entropy and rejected, in place of columns of these names.

    Whole texts are scored. A null text, one without a letter, and any text under a model without languages gets `und`,
    score 0, a null entropy, and is rejected. Equal entropies go to the language first in order. The model is broadcast;
    its size is bounded by that of the sample. Rows are independent: repeated rows and other columns pass through.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("language string, score double, entropy double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield shared.value.score(s.tolist())

    # Not deterministic, as far as the optimizer knows: a filter on the outcome would else score every text once more.
    found = docs.withColumn("_l", run.asNondeterministic()(F.col(text).cast("string")))
    return found.withColumns({
        "lang_pred": F.col("_l.language"), "score": F.col("_l.score"),
        "entropy": F.nanvl(F.col("_l.entropy"), F.lit(None).cast("double")), "rejected": F.col("_l.rejected"),
    }).drop("_l")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(sample_labelled(docs))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy", "rejected")


QUERIES = {"op2_language": op2_language}
ORACLE: dict[str, str] = {}
