"""What small molecules are called: the table of chosen identifiers, and how such a table is made and reviewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .identifiers import OBO, is_bare, literal_map, prefix_of, trimmed

CID = "http://rdf.ncbi.nlm.nih.gov/pubchem/compound/CID"
# By identifier of a node, the number of its compound and its ChEBI number (null for none).
COMPOUNDS = {
    "CHEBI:17336": ("445354", "12777"),
    "CHEBI:31690": ("5291", "45783"),
    "CHEBI:16302": ("5280382", "16302"),
    "CHEBI:16330": ("10635", "16330"),
    "CHEBI:16595": ("439456", "16595"),
    "CHEBI:52392": ("5282280", "52392"),
    "CHEBI:17489": ("6076", "17489"),
    "CHEBI:16356": ("135398570", "16356"),
    "cas:11128-99-7": ("25476", None),
    "CHEBI:48080": ("5287620", "48080"),
    "CHEBI:16113": ("5997", "16113"),
    "CHEBI:15354": ("305", "15354"),
    "CHEBI:17650": ("5754", "17650"),
    "CHEBI:4031": ("5284373", "4031"),
    "cas:51-61-6": ("681", "18243"),
    "cas:50-28-2": ("5757", "16469"),
    "cas:85305-87-9": ("6475228", "84744"),
    "cas:17-18-8": ("124886", "16856"),
    "CHEBI:28087": ("439177", "28087"),
    "cas:9005-49-6": ("22833565", "28304"),
    "cas:74-79-3": ("6322", "16467"),
    "cas:372-75-8": ("9750", "16349"),
    "CHEBI:78331": ("4878", "78331"),
    "CHEBI:15552": ("5282411", "15552"),
    "CHEBI:37550": ("5283560", "37550"),
    "CHEBI:61049": ("445643", "61049"),
    "CHEBI:17347": ("6013", "17347"),
    "CHEBI:15627": ("5280497", "15627"),
    "cas:133-89-1": ("8629", "46229"),
}
# ChEBI identifiers that stand for themselves.
KEPT = ["16066", "17898", "28940", "16618", "3098", "50114", "24547", "39026", "16337", "26523"]
# Decisions of people on single identifiers: keep the identifier, or ask for another in its place.
KEEP = ["CHEBI:16066", "CHEBI:17898", "CHEBI:28940"]
ASK = {"cas:17-18-8": "CAS:70-18-8"}
# Prefixes as the normalizer writes them, the stems of the two that are chosen, and flags from the worst down.
PREFIX_CASE = {"chebi": "CHEBI", "cas": "CAS", "kegg.compound": "KEGG.COMPOUND"}
STEMS = {"PUBCHEM.COMPOUND": CID, "CHEBI": f"{OBO}CHEBI_"}
FLAGS = ["COLLISION", "CHEBI-DRIFT", "OVERRIDE", "NO-CID", "OK", "UNRESOLVED", "NO-ID"]


def chosen(spark: SparkSession) -> DataFrame:
    """(source, iri, exact): the chosen IRI of each identifier of the table, and the counterparts that it has."""
    rows = [(k, CID + c, [f"{OBO}CHEBI_{b}"] if b else []) for k, (c, b) in COMPOUNDS.items()]
    rows += [(f"CHEBI:{b}", f"{OBO}CHEBI_{b}", []) for b in KEPT]
    return spark.createDataFrame(rows, "source string, iri string, exact array<string>")


def normalizer_curie(identifier: Column, ask: dict[str, str] | None = None) -> Column:
    """What the normalizer is asked for: another identifier where one was decided on, else the prefix in its own case; null
    for a bare name."""
    prefix = prefix_of(identifier)
    own = F.concat(F.coalesce(F.try_element_at(literal_map(PREFIX_CASE), F.lower(prefix)), prefix), F.substr(identifier, F.instr(identifier, ":")))
    return F.coalesce(F.try_element_at(literal_map(ask or ASK), identifier), F.when(~is_bare(identifier), own))


def to_iri(curie: Column) -> Column:
    """A CURIE of a known stem in full; else unchanged."""
    stem = F.when(~is_bare(curie), F.try_element_at(literal_map(STEMS), prefix_of(curie)))
    return F.coalesce(F.concat(stem, F.substr(curie, F.instr(curie, ":") + 1)), curie)


def first_of(clique: Column, prefix: str) -> Column:
    """The first identifier of a clique that begins with ``prefix``; null if none does."""
    return F.get(F.filter(clique, lambda x: x.startswith(prefix)), F.lit(0))


def profile(nodes: DataFrame) -> DataFrame:
    """One row for each identifier of ``nodes`` (net, represents, name): source, name (the least), names, networks, instances.

    A node without an identifier goes by its name, one without either is left out.
    """
    source = F.coalesce("represents", "name")
    known = nodes.where(F.coalesce(source != "", F.lit(False)))
    return known.groupBy(source.alias("source")).agg(
        F.min(F.nullif(F.col("name"), F.lit(""))).alias("name"), F.array_sort(F.collect_set(F.nullif(F.col("name"), F.lit("")))).alias("names"), F.count_distinct("net").alias("networks"), F.count("*").alias("instances")
    )


def review(profiles: DataFrame, normalized: DataFrame, keep: list[str] | None = None, ask: dict[str, str] | None = None) -> DataFrame:
    """One row for each of ``profiles`` (source, ...) with asked, pubchem, chebi, label, chosen, chosen_iri, flag, collides_with.

    ``normalized`` is (curie, label, clique), one row for each identifier that the normalizer knows. Chosen is the compound
    of the clique, else its ChEBI identifier, else what was asked for. Flags: NO-ID for a bare name, UNRESOLVED for what is
    not known or has neither, OK and NO-CID for the two choices; CHEBI-DRIFT goes over these where a ChEBI identifier got
    another one, OVERRIDE over all where ``keep`` says so. Where several sources come to one choice, all are COLLISION and
    name the others.
    """
    table = normalized.select(F.col("curie").alias("_curie"), F.col("label").alias("_label"), F.col("clique").alias("_clique"))
    rows = profiles.withColumn("asked", normalizer_curie(F.col("source"), ask)).join(table, F.col("asked") == F.col("_curie"), "left")
    rows = rows.withColumns({"pubchem": first_of(F.col("_clique"), "PUBCHEM.COMPOUND:"), "chebi": first_of(F.col("_clique"), "CHEBI:")})
    kept, found = F.col("source").isin(*(KEEP if keep is None else keep)), F.col("_curie").isNotNull()
    drift = F.col("asked").startswith("CHEBI:") & (F.col("chebi") != F.col("asked"))
    flag = (
        F.when(F.col("asked").isNull(), "NO-ID").when(~found, "UNRESOLVED").when(kept, "OVERRIDE").when(drift, "CHEBI-DRIFT")
        .when(F.col("pubchem").isNotNull(), "OK").when(F.col("chebi").isNotNull(), "NO-CID").otherwise("UNRESOLVED")
    )
    choice = F.when(F.col("asked").isNull(), F.col("source")).when(found & kept, F.col("source")).otherwise(F.coalesce("pubchem", "chebi", "asked"))
    rows = rows.withColumns({"label": F.col("_label"), "chosen": choice, "flag": flag}).withColumn("chosen_iri", F.when(F.col("flag") == "NO-ID", F.col("source")).otherwise(to_iri(F.col("chosen")))).drop("_curie", "_label", "_clique")
    return collisions(rows, "chosen", "source", "flag", ["UNRESOLVED", "NO-ID"])


def collisions(rows: DataFrame, chosen: str, source: str, flag: str, apart: list[str]) -> DataFrame:
    """``rows`` with collides_with: the other sources of the same choice, sorted; their flag becomes COLLISION. Rows with a
    flag of ``apart`` take no part."""
    taking = ~F.col(flag).isin(*apart)
    groups = rows.where(taking).groupBy(F.col(chosen).alias("_c")).agg(F.array_sort(F.collect_set(source)).alias("_s")).where(F.size("_s") > 1)
    marked = rows.join(groups, taking & (F.col(chosen) == F.col("_c")), "left")
    return marked.withColumns({"collides_with": F.array_except("_s", F.array(source)), flag: F.when(F.col("_s").isNotNull(), "COLLISION").otherwise(F.col(flag))}).drop("_c", "_s")


def severity(flag: Column) -> Column:
    """The place of a flag among all, the worst first, from 1; 0 for another."""
    return F.array_position(F.array(*[F.lit(x) for x in FLAGS]), flag)


def in_review_order(rows: DataFrame) -> DataFrame:
    """Rows by severity of their flag, then name in any case, then source."""
    return rows.orderBy(severity(F.col("flag")), F.lower("name"), "source")


def snapshot(rows: DataFrame, normalized: DataFrame) -> DataFrame:
    """(source, iri, exact) of reviewed ``rows``: the table that conversion takes. Bare names and what is not resolved are
    left out; a kept identifier has no counterparts, others the one of compound and ChEBI identifier that was not chosen."""
    real = rows.where(~F.col("flag").isin("UNRESOLVED", "NO-ID"))
    both = F.filter(F.array("pubchem", "chebi"), lambda x: x.isNotNull() & (x != F.col("chosen")))
    exact = F.when(F.col("chosen") == F.col("source"), F.array().cast("array<string>")).otherwise(F.transform(both, to_iri))
    return real.select("source", F.col("chosen_iri").alias("iri"), exact.alias("exact"))


def markdown(rows: DataFrame, title: str) -> DataFrame:
    """The review as lines of Markdown, one a row (ord, value): counts by flag, then the rows in review order."""
    cell = lambda c: F.coalesce(F.nullif(trimmed(F.replace(F.col(c), F.lit("|"), F.lit("\\|"))), F.lit("")), F.lit("—"))
    code = lambda c: F.coalesce(F.concat(F.lit("`"), F.col(c), F.lit("`")), F.lit("—"))
    spark = rows.sparkSession
    counts = rows.groupBy("flag").agg(F.count("*").alias("_n")).select(F.struct(F.lit(1), severity(F.col("flag")).cast("long"), F.lit(""), F.lit("")).alias("ord"), F.concat(F.lit("| `"), "flag", F.lit("` | "), F.col("_n").cast("string"), F.lit(" |")).alias("value"))
    others = F.coalesce(F.nullif(F.array_join("collides_with", ", "), F.lit("")), F.lit("—"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", code("source"), cell("name"), code("flag"), code("chosen"), cell("pubchem"), cell("chebi"), cell("label"), others, F.col("instances").cast("string")), F.lit(" |"))
    body = rows.select(F.struct(F.lit(3), severity(F.col("flag")).cast("long"), F.coalesce(F.lower("name"), F.lit("")), F.col("source")).alias("ord"), line.alias("value"))
    heads = [(0, f"# {title}"), (0, ""), (0, "| Flag | Count |"), (0, "|---|---:|"), (2, ""), (2, "| Source | Name | Flag | Chosen | Compound | ChEBI | Label | Collides with | Nodes |"), (2, "|---|---|---|---|---|---|---|---|---:|")]
    fixed = spark.createDataFrame([(a, k, v) for k, (a, v) in enumerate(heads)], "a int, k long, value string").select(F.struct("a", "k", F.lit(""), F.lit("")).alias("ord"), "value")
    return fixed.union(counts).union(body).orderBy("ord")
