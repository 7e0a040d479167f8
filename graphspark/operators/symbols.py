"""Gene symbols to identifiers: a reference table as indexes, and the chain of tiers that a symbol goes through."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.functions.identifiers import prefix_of
from graphspark.operators.resolve import cascade


def listed(column: str) -> Column:
    """The parts of a column that are separated by |, without empty ones; empty for null."""
    return F.filter(F.split(F.coalesce(F.col(column), F.lit("")), r"\|"), lambda x: x != "")


@dataclass
class Reference:
    """approved (symbol, accessions, gene), previous, alias (symbol, accessions, gene, ord) and withdrawn (symbol, gene).

    ``ord`` is the place in the reference table; of a symbol that is listed more than once the first counts.
    """

    approved: DataFrame
    previous: DataFrame
    alias: DataFrame
    withdrawn: DataFrame


def reference(table: DataFrame, withdrawn: DataFrame | None = None, status: str = "Approved") -> Reference:
    """Indexes of a reference ``table`` (symbol, hgnc_id, status, uniprot_ids, prev_symbol, alias_symbol; lists separated by |)
    as it was read, rows of another status left out, and of the withdrawn symbols (symbol, gene). The last row of an approved
    or withdrawn symbol counts."""
    rows = table.where(F.col("status") == status).select("symbol", F.col("hgnc_id").alias("gene"), listed("uniprot_ids").alias("accessions"), listed("prev_symbol").alias("_prev"), listed("alias_symbol").alias("_alias"), F.monotonically_increasing_id().alias("_at"))
    approved = rows.groupBy("symbol").agg(F.max_by(F.struct("accessions", "gene"), "_at").alias("_r")).select("symbol", "_r.*")
    other = lambda c: rows.select(F.posexplode(c).alias("_i", "_s"), "accessions", "gene", "_at").select(F.col("_s").alias("symbol"), "accessions", "gene", F.struct("_at", "_i").alias("ord"))
    gone = withdrawn if withdrawn is not None else table.sparkSession.createDataFrame([], "symbol string, gene string")
    gone = gone.select("symbol", "gene", F.monotonically_increasing_id().alias("_at")).groupBy("symbol").agg(F.max_by("gene", "_at").alias("gene"))
    return Reference(approved, other("_prev"), other("_alias"), gone)


def symbols(edges: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol): the distinct symbols of the ``columns``; nulls are none."""
    out = None
    for c in columns:
        own = edges.select(F.col(c).alias("symbol"))
        out = own if out is None else out.union(own)
    return out.where(F.col("symbol").isNotNull()).distinct()


def resolve(found: DataFrame, ref: Reference, cache: DataFrame) -> DataFrame:
    """symbol, curie, id_type, route, gene, accessions and note of each of ``found`` (symbol, distinct).

    The first tier with an accession gives a protein: the approved symbol, previous symbols, aliases, then ``cache`` (symbol,
    accessions, route) of landed lookups. More candidates than one with an accession at one of the middle two tiers make the
    route _ambiguous. A symbol without an accession is a gene: by the id of its approved, else its previous, else its
    withdrawn symbol, and at last by the symbol itself. The canonical accession is the first that is listed.
    """
    some = F.size("accessions") > 0
    value = F.struct("accessions", "gene").alias("value")
    approved = ref.approved.where(some).select("symbol", value, F.lit(0).alias("ord"))
    tiers = [("approved_symbol", approved, ["ord"])]
    for name, table in (("prev_symbol", ref.previous), ("alias_symbol", ref.alias)):
        tiers.append((name, table.where(some).select("symbol", value, "ord"), ["ord"]))
    landed = cache.where(some).groupBy("symbol").agg(F.max_by(F.struct("accessions", "route"), "route").alias("_c"))
    out = cascade(found.select("symbol"), "symbol", tiers).join(landed, "symbol", "left")
    ids = [ref.approved.select("symbol", F.col("gene").alias("_g0")), ref.previous.groupBy("symbol").agg(F.min_by("gene", "ord").alias("_g1")), ref.withdrawn.select("symbol", F.col("gene").alias("_g2"))]
    for t in ids:
        out = out.join(t, "symbol", "left")
    accessions = F.coalesce("resolved.accessions", "_c.accessions")
    gene = F.coalesce(*[F.nullif(F.col(f"_g{k}"), F.lit("")) for k in range(3)])
    local = F.substr(gene, F.instr(gene, ":") + 1)
    protein = accessions.isNotNull()
    route = F.when(F.col("resolved").isNotNull(), F.col("route")).when(protein, F.col("_c.route")).when(gene.isNotNull(), "hgnc_id_fallback").otherwise("hgnc_symbol_fallback")
    curie = F.when(protein, F.concat(F.lit("uniprot:"), accessions[0])).when(gene.isNotNull(), F.concat(F.lit("hgnc:"), local)).otherwise(F.concat(F.lit("hgnc.symbol:"), "symbol"))
    return out.select("symbol", curie.alias("curie"), F.when(protein, "protein").otherwise("gene").alias("id_type"), route.alias("route"), F.when(~protein, F.substr(curie, F.instr(curie, ":") + 1)).alias("gene"), F.coalesce(accessions, F.array().cast("array<string>")).alias("accessions"), F.when(~protein, "no protein, a gene identifier").alias("note"))


def with_fallback(found: DataFrame, table: DataFrame) -> DataFrame:
    """``found`` (symbol, ...) with curie, id_type and missing: what ``table`` (symbol, curie, id_type) says, else a gene by
    its symbol."""
    t = table.select("symbol", "curie", "id_type").dropDuplicates(["symbol"])
    both = found.join(t, "symbol", "left")
    return both.withColumns({"missing": F.col("curie").isNull(), "id_type": F.when(F.col("curie").isNull(), "gene").otherwise(F.col("id_type")), "curie": F.coalesce("curie", F.concat(F.lit("hgnc.symbol:"), "symbol"))})


def report(resolved: DataFrame) -> DataFrame:
    """One row: symbols, proteins, genes, distinct accessions and how many symbols share one with another."""
    protein = F.col("id_type") == "protein"
    distinct = F.count_distinct(F.when(protein, F.col("curie")))
    return resolved.agg(F.count("*").alias("symbols"), F.count_if(protein).alias("proteins"), F.count_if(~protein).alias("genes"), distinct.alias("accessions"), (F.count_if(protein) - distinct).alias("lost"))


def shared_identifiers(resolved: DataFrame, most: int = 40) -> DataFrame:
    """curie, n and symbols of the ``most`` identifiers that the most symbols share, only those of proteins."""
    groups = resolved.where((F.col("id_type") == "protein") & (prefix_of(F.col("curie")) == "uniprot")).groupBy("curie").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("symbol")).alias("symbols"))
    return groups.where("n > 1").orderBy(F.desc("n"), "curie").limit(most)
