"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are what the base expressions find. The words beside seeds are patterns; patterns and the tokens that they stand
beside form a graph, on which scores are passed to and fro: a pattern is as good as the share of its tokens that are
known, a token as good as its patterns together. Tokens of a fitting shape whose score passes the threshold are known
from then on. Every text is scanned once; what is found, with its neighbours, is written and all else works on that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read, store

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: The base expressions, with possessive loops and starts at the front of a run of characters: the same matches in linear time.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A candidate: a run of visible characters with a digit or an at sign in it.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: A candidate as well: groups of digits with single spaces between them.
SPACED = r"(?<!\S)[(+]{0,2}+[0-9][0-9().-]*+(?:\x20[(]?+[0-9][0-9().-]*+)+[,;:!?]{0,3}(?!\S)"
CANDIDATES = {"token": TOKEN, "spaced": SPACED}
#: What a candidate must look like to be of a kind.
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[^0-9]{0,2}[0-9]{1,3}([.:][0-9]{1,3}){3}([:/][0-9]{1,5})?[^0-9]{0,3}$",
    "card": r"^[^0-9]{0,2}[0-9](?:[\x20-]?[0-9]){11,18}[^0-9]{0,3}$",
    "phone": r"^[^0-9]{0,2}[0-9][0-9()\x20.-]{5,18}[0-9][^0-9]{0,3}$",
}
#: Rounds of scoring; distinct known tokens that a pattern needs; scores from which patterns and tokens count; the
#: longest neighbour, in characters.
ROUNDS, SUPPORT, GOOD_PATTERN, GOOD_TOKEN, LONGEST = 3, 4, 0.8, 0.9, 64
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, m: Column) -> Column:
    """If a base match passes the checks of its kind."""
    digits = _digits(m)
    size = F.length(digits)
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(kind == "card", F.when(size.between(16, 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", size.between(8, 15))
        .otherwise(False)
    )


def _word(gap: Column, last: bool) -> Column:
    """The word of a gap next to the match, in lower case without marks at its ends; # if the gap is blank."""
    plain = F.translate(gap, "\n\r\t", "   ")
    word = F.substring_index(F.rtrim(plain) if last else F.ltrim(plain), " ", -1 if last else 1)
    short = F.lower(F.substring(word, 1, LONGEST))
    return F.when(short == "", "#").otherwise(F.regexp_replace(short, r"^[\p{P}&&[^=:]]+|[\p{P}&&[^=:]]+$", ""))


def mentions(docs: DataFrame) -> DataFrame:
    """One row for each match of a base expression and for each candidate, and a row with a null kind for each document:
    row, doc_id, kind, nth, gap (characters since the match before), size, token, left, right. Written to the shared folder.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.when(text.rlike("[0-9@]"), text).otherwise("").alias("_t"))
    for kind, pattern in (BASE | CANDIDATES).items():
        rows = rows.withColumns({f"_gaps_{kind}": F.split("_t", pattern, -1), f"_found_{kind}": F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))})
    fields = "kind string, nth int, gap int, size int, token string, left string, right string"
    everything = F.array(F.lit(None).cast(f"struct<{fields}>"))
    for kind in (*BASE, *CANDIDATES):
        everything = F.concat(everything, _items(kind))
    return store(rows.select("row", "doc_id", everything.alias("_m")).select("row", "doc_id", F.explode_outer("_m").alias("_m")).select("row", "doc_id", "_m.*"), "mentions")


def _items(kind: str) -> Column:
    """A struct for each match of a kind, from the columns of matches and gaps."""
    gaps = F.col(f"_gaps_{kind}")

    def item(m: Column, i: Column) -> Column:
        here, after = F.get(gaps, i), F.get(gaps, i + 1)
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("nth"), F.length(here).alias("gap"), F.length(m).alias("size"),
            m.alias("token"), _word(here, True).alias("left"), _word(after, False).alias("right"),
        )

    return F.transform(f"_found_{kind}", item)


def _placed(found: DataFrame) -> DataFrame:
    """Mentions with start and end in code points, and ok: a base match that passes its checks."""
    each = W.partitionBy("row", "kind").orderBy("nth")
    start = F.sum(F.col("gap")).over(each) + F.sum(F.col("size")).over(each) - F.col("size")
    return found.where(F.col("kind").isNotNull()).withColumn("start", start).withColumns({"end": F.col("start") + F.col("size"), "ok": _valid(F.col("kind"), F.col("token"))})


def _candidates(placed: DataFrame) -> DataFrame:
    """Candidates that overlap no base span: row, doc_id, start, end, token, left, right."""
    by_start = W.partitionBy("row").orderBy("start", "end")
    base, candidate = F.col("ok"), F.col("kind").isin(*CANDIDATES)
    before = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(1, W.unboundedFollowing))
    return (
        placed.where(base | (candidate & (F.col("size") >= 5)))
        .withColumns({"_before": before, "_after": after})
        .where(candidate & (F.coalesce(F.col("_before"), F.lit(0)) <= F.col("start")) & F.coalesce(F.col("_after") >= F.col("end"), F.lit(True)))
        .select("row", "doc_id", "start", "end", "token", "left", "right")
    )


def _patterns(frame: DataFrame, *keep: str) -> DataFrame:
    """Each row by its patterns: the word before, and both neighbours."""
    both = F.concat_ws(" _ ", "left", "right")
    return frame.select(*keep, F.explode(F.array(F.concat(F.col("left"), F.lit(" _")), both)).alias("pattern"))


def bootstrap(placed: DataFrame, candidates: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Spans that patterns add, without those inside another of their kind: row, doc_id, kind, start, end."""
    shaped = candidates.select("*", F.explode(F.array(*[F.when(F.col("token").rlike(p), F.lit(k)) for k, p in SHAPES.items()])).alias("kind")).where(F.col("kind").isNotNull())
    seeds = _patterns(placed.where("ok"), "kind", "token").distinct().withColumn("score", F.lit(1.0))
    edges = _patterns(shaped, "kind", "token").distinct()
    edges = store(seeds.unionByName(edges.withColumn("score", F.lit(0.0))).groupBy("kind", "pattern", "token").agg(F.max("score").alias("seed")), "edges")
    known = edges.select("kind", "token", F.col("seed").alias("score")).groupBy("kind", "token").agg(F.max("score").alias("score"))
    good: DataFrame | None = None
    for _ in range(rounds):
        scored = edges.join(known, ["kind", "token"]).groupBy("kind", "pattern").agg(F.sum("score").alias("_sum"), F.count("*").alias("_all"), F.sum((F.col("score") >= GOOD_TOKEN).cast("int")).alias("_known"))
        # One is added below, as a token more that would not be known.
        good = store(scored.where(F.col("_known") >= SUPPORT).withColumn("trust", F.col("_sum") / (F.col("_all") + 1)).where(F.col("trust") >= GOOD_PATTERN).select("kind", "pattern", "trust"), "patterns")
        lifted = edges.join(good, ["kind", "pattern"], "left").groupBy("kind", "token").agg(
            F.max("seed").alias("_seed"), (1 - F.exp(F.sum(F.log(1 - F.coalesce("trust", F.lit(0.0)))))).alias("_score")
        )
        known = store(lifted.select("kind", "token", F.greatest("_seed", "_score").alias("score")), "tokens")
    taken = known.where(F.col("score") >= GOOD_TOKEN)
    by_pattern = _patterns(shaped, "row", "doc_id", "kind", "start", "end", "token")
    spans = by_pattern.join(good.select("kind", "pattern"), ["kind", "pattern"]).join(taken.select("kind", "token"), ["kind", "token"]).select("row", "doc_id", "kind", "start", "end").distinct()
    before = W.partitionBy("row", "kind").orderBy("start", F.desc("end")).rowsBetween(W.unboundedPreceding, -1)
    return spans.withColumn("_before", F.max("end").over(before)).where(F.coalesce(F.col("_before") < F.col("end"), F.lit(True))).drop("_before")


def find_pii(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, base and spans, arrays of (kind, start, end) sorted by kind as
    listed in ``KINDS``, then start; ends are exclusive and places count code points.

    ``base`` is what the base expressions give: leftmost matches that do not overlap within a kind, without those that
    fail the checks. ``spans`` adds what the patterns find outside base spans. A null or empty text has none; repeated
    rows have each their own; a null doc_id stays null; other columns are left out.
    """
    found = mentions(docs)
    placed = store(_placed(found), "placed")
    added = bootstrap(placed, _candidates(placed))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct(rank.alias("rank"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("kind"))
    empty = F.lit(None).cast("struct<rank: bigint, start: bigint, end: bigint, kind: string>")
    every = (
        found.where(F.col("kind").isNull()).select("row", "doc_id", empty.alias("_base"), empty.alias("_more"))
        .unionByName(placed.where("ok").select("row", "doc_id", span.alias("_base"), empty.alias("_more")))
        .unionByName(added.select("row", "doc_id", empty.alias("_base"), span.alias("_more")))
    )
    grouped = every.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("_base")).alias("base"), F.collect_list("_more").alias("_more"))
    return grouped.select("row", "doc_id", "base", F.array_sort(F.array_distinct(F.concat("base", "_more"))).alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


QUERIES = {"op1_pii": op1_pii}
ORACLE: dict[str, str] = {}
