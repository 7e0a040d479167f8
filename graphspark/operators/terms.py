"""Ontology terms for coded cohorts: candidates of searches, verified by how they are anchored, the best one chosen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anchors from the strongest to the weakest; from REVIEW on a person has to look.
TIERS = ["override", "oncotree_xref", "exact_synonym", "exact_label", "synonym_match"]
REVIEW = "synonym_match"
STEM = "http://purl.obolibrary.org/obo/MONDO_"


def cross_reference(xrefs: Column, database: str = "ONCOTREE") -> Column:
    """The id of the first cross reference (database, id) to ``database``, in any case; empty if there is none."""
    found = F.filter(xrefs, lambda x: F.upper(F.coalesce(x["database"], F.lit(""))) == database)
    return F.coalesce(F.get(found, F.lit(0))["id"], F.lit(""))


def synonyms(of: Column) -> Column:
    """The synonyms that are not empty; none for null."""
    return F.filter(F.coalesce(of, F.array().cast("array<string>")), lambda x: F.coalesce(x != "", F.lit(False)))


def anchor(code: Column, searched: Column, label: Column, names: Column, xrefs: Column) -> Column:
    """(tier, detail) of the strongest anchor that ties a term to a cohort, null if none does: its cross reference or a
    synonym is the code, its label or a synonym is one of the searched labels, all in any case and without outer spaces."""
    plain = lambda x: F.lower(F.trim(x))
    wanted = F.filter(F.transform(searched, plain), lambda x: x != "")
    known, xref = synonyms(names), cross_reference(xrefs)
    by_code = F.get(F.filter(known, lambda x: F.upper(F.trim(x)) == F.upper(code)), F.lit(0))
    by_label = F.get(F.filter(known, lambda x: F.array_contains(wanted, plain(x))), F.lit(0))
    said = lambda tier, *detail: F.struct(F.lit(tier).alias("tier"), F.concat(*detail).alias("detail"))
    return (
        F.when((xref != "") & (F.upper(xref) == F.upper(code)), said("oncotree_xref", F.lit("ONCOTREE:"), xref))
        .when(by_code.isNotNull(), said("exact_synonym", F.lit('synonym "'), by_code, F.lit('"')))
        .when(F.array_contains(wanted, plain(F.coalesce(label, F.lit("")))), said("exact_label", F.lit('label "'), label, F.lit('"')))
        .when(by_label.isNotNull(), said("synonym_match", F.lit('synonym "'), by_label, F.lit('"')))
    )


def candidates(cohorts: DataFrame, searches: DataFrame, rows: int = 8) -> DataFrame:
    """(code, term, ord): the terms that searching for a cohort's code and its labels gives, each once at its first place.

    ``cohorts`` are (code, searched), ``searches`` (query, terms) with terms in order of relevance, of which the first
    ``rows`` of each query count. Blank queries are none.
    """
    queries = cohorts.select("code", F.posexplode(F.concat(F.array("code"), "searched")).alias("_q", "query")).where(F.trim("query") != "")
    hits = queries.join(searches, "query").select("code", "_q", F.posexplode(F.slice("terms", 1, rows)).alias("_i", "term"))
    return hits.groupBy("code", "term").agg(F.min(F.struct("_q", "_i")).alias("ord"))


def resolve(cohorts: DataFrame, searches: DataFrame, terms: DataFrame, rows: int = 8) -> DataFrame:
    """code, term, label, iri, route, anchor, xref, alternatives, note of each of ``cohorts`` (code, searched, override).

    ``terms`` are (term, label, synonyms, xrefs, obsolete). An override is taken as it is, unless it is unknown or obsolete,
    which leaves the cohort unresolved. Else the candidates that are known and not obsolete are verified; the strongest
    anchor wins, of equal ones the first that was found, and the others of its tier are listed as alternatives.
    """
    t = terms.dropDuplicates(["term"])
    pinned = cohorts.where(F.coalesce(F.col("override") != "", F.lit(False))).join(t.withColumn("_known", F.lit(True)), F.col("override") == F.col("term"), "left")
    bad = F.when(F.col("_known").isNull(), F.concat(F.lit("override "), "override", F.lit(" is not known"))).when(F.col("obsolete"), F.concat(F.lit("override "), "override", F.lit(" is obsolete")))
    good = bad.isNull()
    by_hand = pinned.select(
        "code", F.when(good, F.col("override")).alias("term"), F.when(good, F.col("label")).alias("label"), F.when(good, "override").otherwise("unresolved").alias("route"), F.when(good, "pinned").alias("anchor"),
        F.when(good, cross_reference(F.col("xrefs"))).alias("xref"), F.lit("").alias("alternatives"), F.coalesce(bad, F.lit("")).alias("note"),
    )
    open_ = cohorts.where(~F.coalesce(F.col("override") != "", F.lit(False)))
    found = candidates(open_.select("code", "searched"), searches, rows)
    tried = found.groupBy("code").agg(F.count("*").alias("_tried"))
    known = found.join(t.where(~F.coalesce("obsolete", F.lit(False))), "term").join(open_.select("code", "searched"), "code")
    scored = known.withColumn("_a", anchor(F.col("code"), F.col("searched"), F.col("label"), F.col("synonyms"), F.col("xrefs"))).where(F.col("_a").isNotNull())
    scored = scored.withColumn("_rank", F.array_position(F.array(*[F.lit(x) for x in TIERS]), F.col("_a.tier")))
    # A cohort's candidates are bounded by its searches and the rows of each.
    ranked = scored.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("_rank", "ord", "term", "label", "_a", cross_reference(F.col("xrefs")).alias("xref")))).alias("_s"))
    best = F.get("_s", F.lit(0))
    ties = F.transform(F.filter(F.slice("_s", F.lit(2), F.greatest(F.size("_s") - 1, F.lit(0))), lambda x: x["_rank"] == best["_rank"]), lambda x: x["term"])
    tier = best["_a"]["tier"]
    notes = F.array(F.when(tier == REVIEW, "REVIEW: only a weak anchor"), F.when(F.size(ties) > 0, F.concat(F.lit("REVIEW: tie at "), tier)))
    nothing = F.concat(F.lit("no candidate is anchored ("), F.coalesce("_tried", F.lit(0)).cast("string"), F.lit(" searched)"))
    by_search = open_.select("code").join(ranked, "code", "left").join(tried, "code", "left").select(
        "code", best["term"].alias("term"), best["label"].alias("label"), F.coalesce(tier, F.lit("unresolved")).alias("route"), best["_a"]["detail"].alias("anchor"), best["xref"].alias("xref"),
        F.coalesce(F.array_join(ties, " "), F.lit("")).alias("alternatives"), F.when(F.col("_s").isNull(), nothing).otherwise(F.array_join(F.filter(notes, lambda x: x.isNotNull()), "; ")).alias("note"),
    )
    both = by_hand.unionByName(by_search)
    return both.withColumn("iri", F.concat(F.lit(STEM), F.substr(F.col("term"), F.instr("term", ":") + 1)))
