"""A hierarchy of systems over a scored network: augmented networks, and the facts that follow from both."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphspark.functions import identifiers as I
from graphspark.operators import hierarchy, select
from graphspark.operators.positions import dense_ids, dense_positions
from graphspark.plans.convert import RDF, RDFS, Places, exploded_facts
from graphspark.sources.cx2 import Networks, by_full_name

# Terms of public vocabularies that the facts use, and classes of the network's nodes.
BIOLINK, DCTERMS, PROV, PAV, VOID = "https://w3id.org/biolink/vocab/", "http://purl.org/dc/terms/", "http://www.w3.org/ns/prov#", "http://purl.org/pav/", "http://rdfs.org/ns/void#"
NODE_CLASS = {"protein": f"{I.SIO}010043", "gene": f"{I.SIO}010035"}
CANCER, EVIDENCE = f"{I.OBO}MONDO_0004992", f"{I.OBO}ECO_0007672"
KNOWN = {"uniprot": "http://purl.uniprot.org/uniprot/", "hgnc": "http://identifiers.org/hgnc/", "MONDO": f"{I.OBO}MONDO_", "SIO": I.SIO}
# Columns of a scored edge table, by the attribute that they become; all are doubles but the role.
SCORES = {
    "Integrated score": "integrated_score",
    "evidence: Physical": "physical_evidence",
    "evidence: mRNA co-expression": "mrna_coexpression_evidence",
    "evidence: Protein co-expression": "protein_coexpression_evidence",
    "evidence: Co-dependence": "codependence_evidence",
    "evidence: Sequence similarity": "sequence_similarity_evidence",
}
ROLE = "edge_role"
#: From this size on, systems emit neither members nor associations, unless a caller says otherwise.
CUTOFF = 400


@dataclass(frozen=True)
class Fields:
    """What a hierarchy's node attributes are called. The p-value's name has two spaces in the source."""

    identifier: str
    label: str = "Annotation"
    size: str = "Size"
    weight: str = "Weight"
    p_value: str = "adjusted  p-value"
    cohorts: str = "Significantly mutated cancer types"
    frequency: str = "Mutation frequency:"
    genes: str = "Genes"
    members: str = "HCX::members"
    member_names: str = "HCX::memberNames"
    is_root: str = "HCX::isRoot"


def words(text: Column) -> Column:
    """The parts of a list that is separated by white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")


def systems(nodes: DataFrame, fields: Fields) -> DataFrame:
    """node, identifier, label, size, weight, p_value, cohorts (sorted), frequencies (map), members of ``nodes`` (id, v), v by
    full names as texts."""
    v = F.col("v")
    number = lambda name, kind: F.try_element_at(v, F.lit(name)).try_cast(kind)
    text = lambda name: F.try_element_at(v, F.lit(name))
    rates = F.map_filter(v, lambda k, _: k.startswith(fields.frequency))
    rates = F.transform_values(F.transform_keys(rates, lambda k, _: F.substr(k, F.lit(len(fields.frequency) + 1))), lambda _, x: x.try_cast("double"))
    return nodes.select(
        F.col("id").alias("node"), text(fields.identifier).alias("identifier"), text(fields.label).alias("label"), number(fields.size, "bigint").alias("size"), number(fields.weight, "double").alias("weight"),
        number(fields.p_value, "double").alias("p_value"), F.array_sort(words(text(fields.cohorts))).alias("cohorts"), rates.alias("frequencies"), F.from_json(text(fields.members), "array<bigint>").alias("members"),
    )


def full_named(nets: DataFrame, declared: DataFrame) -> DataFrame:
    """``nets`` (net, id, v) with v by full names as ``declared`` (net, declared) says, without defaults."""
    return nets.join(declared, "net").withColumn("v", by_full_name(F.col("v"), F.col("declared"))).drop("declared")


def iri_of(identifier: Column, places: Places) -> Column:
    return F.concat(F.lit(places.base), I.local_name(identifier))


def system_facts(found: DataFrame, places: Places = Places()) -> DataFrame:
    """s, p, o, kind of each system: class, label, identifier and size always, the weight where it is neither null nor 0, the
    p-value where it is not null."""
    own = places.vocabulary
    rows = found.withColumn("_iri", iri_of(F.col("identifier"), places))
    weight = F.when(F.col("weight") != 0, I.double_lexical(F.col("weight")))
    return exploded_facts(rows, "_iri", [
        (f"{RDF}type", F.lit(f"{own}ProteinSystem"), "iri"), (f"{RDFS}label", F.col("label"), "string"), (f"{DCTERMS}identifier", F.col("identifier"), "string"),
        (f"{own}memberCount", F.col("size"), "nonNegativeInteger"), (f"{own}selectionWeight", weight, "double"), (f"{own}selectionPValue", I.double_lexical(F.col("p_value")), "double"),
    ]).drop("i")


def containment_facts(edges: DataFrame, found: DataFrame, places: Places = Places()) -> DataFrame:
    """s, p, o: every child is part of its parent (edges run from parent s to child t), whatever its size."""
    nodes = found.select("node", iri_of(F.col("identifier"), places).alias("iri"))
    return hierarchy.containment(edges.select(F.col("s").alias("parent"), F.col("t").alias("child")), nodes, f"{BIOLINK}part_of")


def member_facts(found: DataFrame, nodes: DataFrame, places: Places = Places(), cutoff: int = CUTOFF) -> DataFrame:
    """s, p, o: the members of systems below ``cutoff`` by the IRIs of ``nodes`` (node, iri); those without one are left out."""
    small = select.with_payload(found, "size", cutoff).select(iri_of(F.col("identifier"), places).alias("s"), F.explode("members").alias("node"))
    return small.join(nodes.select("node", F.col("iri").alias("o")), "node").select("s", F.lit(f"{BIOLINK}has_member").alias("p"), "o")


def cohort_rows(found: DataFrame, terms: DataFrame, cutoff: int = CUTOFF) -> DataFrame:
    """identifier, code, term, label, frequency: one row for each cohort of a system below ``cutoff``, wide columns made long;
    term is null where ``terms`` (code, term, label) lacks the code."""
    each = select.with_payload(found, "size", cutoff).select("identifier", F.explode("cohorts").alias("code"), "frequencies")
    each = each.withColumn("frequency", F.try_element_at("frequencies", F.col("code"))).drop("frequencies")
    return each.join(terms.select("code", "term", F.col("label").alias("term_label")), "code", "left").select("identifier", "code", "term", F.col("term_label").alias("label"), "frequency")


def _association(rows: DataFrame, iri: Column, subject: Column, object_: Column, frequency: Column, places: Places) -> DataFrame:
    return exploded_facts(rows.withColumns({"_iri": iri, "_s": subject, "_o": object_, "_f": frequency}), "_iri", [
        (f"{RDF}type", F.lit(f"{BIOLINK}Association"), "iri"), (f"{BIOLINK}subject", F.col("_s"), "iri"), (f"{BIOLINK}predicate", F.lit(f"{BIOLINK}genetically_associated_with"), "iri"), (f"{BIOLINK}object", F.col("_o"), "iri"),
        (f"{places.vocabulary}mutatedFraction", I.double_lexical(F.col("_f")), "double"), (f"{BIOLINK}knowledge_level", F.lit(f"{BIOLINK}statistical_association"), "iri"),
        (f"{BIOLINK}agent_type", F.lit(f"{BIOLINK}data_analysis_pipeline"), "iri"), (f"{BIOLINK}has_evidence", F.lit(EVIDENCE), "iri"),
    ]).drop("i")


def cohort_facts(rows: DataFrame, places: Places = Places()) -> DataFrame:
    """s, p, o, kind: an association of a system and a term for each of ``cohort_rows`` that has a term, with its frequency
    where that is not null."""
    system = iri_of(F.col("identifier"), places)
    return _association(rows.where(F.col("term").isNotNull()), F.concat(system, F.lit("-"), "code"), system, F.col("term"), F.col("frequency"), places)


def selection_facts(found: DataFrame, places: Places = Places(), cutoff: int = CUTOFF, level: float = 0.05) -> DataFrame:
    """s, p, o, kind: an association with cancer at large for each system below ``cutoff`` whose p-value is below ``level``."""
    rows, system = select.significant(select.with_payload(found, "size", cutoff), "p_value", level), iri_of(F.col("identifier"), places)
    return _association(rows, F.concat(system, F.lit("-selection")), system, F.lit(CANCER), F.lit(None).cast("double"), places)


def network_nodes(nodes: DataFrame, context: Column) -> DataFrame:
    """node, iri, class and label of ``nodes`` (id, v, and what ``context`` needs); iri is null where represents cannot be
    resolved. A class that is not known is that of proteins."""
    v = F.col("v")
    class_ = F.coalesce(F.try_element_at(I.literal_map(NODE_CLASS), F.lower(v["type"])), F.lit(NODE_CLASS["protein"]))
    return nodes.select(F.col("id").alias("node"), I.exact_iri(F.coalesce(v["represents"], F.lit("")), KNOWN, context).alias("iri"), class_.alias("class"), v["name"].alias("label"))


def interactions(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """edge, s, o, score, backbone, loop: the ``edges`` (id, s, t, v) between ``nodes`` (node, iri) that have an IRI."""
    ids = nodes.where(F.col("iri").isNotNull())
    for side in ("s", "t"):
        edges = edges.join(ids.select(F.col("node").alias(side), F.col("iri").alias(f"_{side}")), side)
    v = F.col("v")
    return edges.select(F.col("id").alias("edge"), F.col("_s").alias("s"), F.col("_t").alias("o"), F.try_element_at(v, F.lit("integrated_score")).try_cast("double").alias("score"), F.coalesce(F.try_element_at(v, F.lit(ROLE)) == "backbone", F.lit(False)).alias("backbone"), (F.col("_s") == F.col("_t")).alias("loop"))


def network_facts(nodes: DataFrame, found: DataFrame, places: Places = Places()) -> DataFrame:
    """s, p, o, kind of the network's nodes and ``interactions``, loops left out: class and label of each node, one triple an
    edge in its own direction, and a statement with the score where there is one and a mark on backbone edges only."""
    own, predicate = places.vocabulary, f"{BIOLINK}interacts_with"
    about = exploded_facts(nodes.where(F.col("iri").isNotNull()), "iri", [(f"{RDF}type", F.col("class"), "iri"), (f"{RDFS}label", F.col("label"), "string")]).drop("i")
    edges = found.where(~F.col("loop"))
    direct = edges.select("s", F.lit(predicate).alias("p"), "o", F.lit("iri").alias("kind"))
    named = edges.withColumns({"_iri": F.concat(F.lit(f"{places.base}e"), F.col("edge").cast("string")), "_s": F.col("s"), "_o": F.col("o")})
    scored = exploded_facts(named, "_iri", [
        (f"{RDF}type", F.lit(f"{RDF}Statement"), "iri"), (f"{RDF}subject", F.col("_s"), "iri"), (f"{RDF}predicate", F.lit(predicate), "iri"), (f"{RDF}object", F.col("_o"), "iri"),
        (f"{own}associationScore", I.double_lexical(F.col("score")), "double"), (f"{own}retainedForConnectivity", F.when(F.col("backbone"), "true"), "boolean"),
    ]).drop("i")
    return about.unionByName(direct).unionByName(scored)


def vocabulary_rows(spark: SparkSession, places: Places = Places()) -> DataFrame:
    """s, p, o, kind: the graph's own class and properties, what they mean, and what they apply to."""
    own, owl, xsd = places.vocabulary, I.STANDARD_PREFIXES["owl"], I.STANDARD_PREFIXES["xsd"]
    system, statement = f"{own}ProteinSystem", f"{RDF}Statement"
    terms: list[tuple[str, str, str, list[tuple[str, str]]]] = [
        ("memberCount", "member count", "How many members the source reports, written or not", [(f"{RDFS}subPropertyOf", f"{BIOLINK}has_count"), (f"{RDFS}domain", system), (f"{RDFS}range", f"{xsd}nonNegativeInteger")]),
        ("mutatedFraction", "mutated fraction", "Share of a cohort's tumors with a mutation in a member of the system", [(f"{RDFS}subPropertyOf", f"{BIOLINK}has_quotient"), (f"{RDFS}domain", f"{BIOLINK}Association"), (f"{RDFS}range", f"{xsd}double")]),
        ("selectionWeight", "selection weight", "Weight of the system in a model of mutational selection", [(f"{RDFS}seeAlso", f"{I.OBO}STATO_0000565"), (f"{RDFS}domain", system), (f"{RDFS}range", f"{xsd}double")]),
        ("selectionPValue", "selection p-value", "Corrected p-value of the system's selection", [(f"{RDFS}seeAlso", f"{I.OBO}OBI_0000175"), (f"{RDFS}seeAlso", f"{I.OBO}NCIT_C61596"), (f"{RDFS}domain", system), (f"{RDFS}range", f"{xsd}double")]),
        ("associationScore", "association score", "Score of an association between two proteins; no probability", [(f"{RDFS}domain", statement), (f"{RDFS}range", f"{xsd}double")]),
        ("retainedForConnectivity", "retained for connectivity", "True where an edge stays only as the best of one of its ends", [(f"{RDFS}domain", statement), (f"{RDFS}range", f"{xsd}boolean")]),
    ]
    rows = [(system, f"{RDF}type", f"{RDFS}Class", "iri"), (system, f"{RDF}type", f"{owl}Class", "iri"), (system, f"{RDFS}label", "protein system", "string"), (system, f"{RDFS}comment", "Proteins that were found to work together, at any scale", "string"), (system, f"{RDFS}subClassOf", f"{BIOLINK}BiologicalEntity", "iri")]
    for name, label, comment, links in terms:
        s = own + name
        rows += [(s, f"{RDF}type", f"{RDF}Property", "iri"), (s, f"{RDF}type", f"{owl}DatatypeProperty", "iri"), (s, f"{RDFS}label", label, "string"), (s, f"{RDFS}comment", comment, "string"), *[(s, p, o, "iri") for p, o in links]]
    return spark.createDataFrame(rows, "s string, p string, o string, kind string")


def provenance_rows(spark: SparkSession, name: str, title: str, description: str, version: str, sources: list[str], date: str | None = None, publisher: str | None = None, source: str | None = None, agent: str | None = None, tool: str = "graphspark", places: Places = Places()) -> DataFrame:
    """s, p, o, kind: one dataset with its version, sources (IRIs), date (today if not given) and the activity that made it, a
    blank node. What is not given is not stated."""
    s, activity = places.base + name, "_:activity"
    rows = [
        (s, f"{RDF}type", f"{VOID}Dataset", "iri"), (s, f"{RDF}type", f"{PROV}Entity", "iri"), (s, f"{DCTERMS}title", title, "string"), (s, f"{DCTERMS}description", description, "string"), (s, f"{DCTERMS}publisher", publisher, "iri"),
        (s, f"{DCTERMS}source", source, "iri"), (s, f"{DCTERMS}created", date, "date"), (s, f"{PAV}version", version, "string"), *[(s, f"{PROV}wasDerivedFrom", x, "iri") for x in sources],
        (s, f"{PROV}wasGeneratedBy", activity, "iri"), (activity, f"{RDF}type", f"{PROV}Activity", "iri"), (activity, f"{PROV}wasAssociatedWith", agent, "iri"), (activity, f"{PAV}version", tool, "string"),
    ]
    found = spark.createDataFrame(rows, "s string, p string, o string, kind string")
    return found.withColumn("o", F.when((F.col("kind") == "date") & F.col("o").isNull(), F.current_date().cast("string")).otherwise(F.col("o"))).where(F.col("o").isNotNull())


def with_members(nodes: DataFrame, edges: DataFrame, table: DataFrame, fields: Fields) -> DataFrame:
    """``nodes`` (id, v) of a hierarchy with is_root, members and member_names: their genes that ``table`` (symbol, node) has,
    by node and symbol, and how many genes there are (genes). There must be exactly one root among them; ``edges`` are (s, t)
    from parent to child."""
    root = hierarchy.only_root(nodes.select(F.col("id").alias("node")), edges.select(F.col("s").alias("parent"), F.col("t").alias("child")))
    each = nodes.select("id", F.explode(words(F.try_element_at("v", F.lit(fields.genes)))).alias("symbol"))
    pairs = F.array_sort(F.collect_list(F.when(F.col("node").isNotNull(), F.struct("node", "symbol"))))
    held = each.join(table.select("symbol", "node"), "symbol", "left").groupBy("id").agg(pairs.alias("_m"), F.count("*").alias("genes"))
    out = nodes.join(held, "id", "left").join(F.broadcast(root.select(F.col("node").alias("_root"))))
    empty = F.array().cast("array<struct<node:bigint,symbol:string>>")
    m = F.coalesce("_m", empty)
    return out.withColumns({"is_root": F.col("id") == F.col("_root"), "members": F.transform(m, lambda x: x["node"]), "member_names": F.transform(m, lambda x: x["symbol"]), "genes": F.coalesce("genes", F.lit(0))}).drop("_m", "_root")


def scored_network(edges: DataFrame, ends: tuple[str, str], table: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, symbol, curie, id_type, missing) and edges (id, s, t, and the other columns) of a scored table.

    Node ids are dense by first appearance, an edge's first end before its second; edge ids go on behind them in row order.
    ``order`` tells rows apart. Symbols that ``table`` (symbol, curie, id_type) lacks are genes by their symbol.
    """
    from graphspark.operators.symbols import with_fallback

    rows = dense_positions(edges, order, "_row")
    both = rows.select(F.col(ends[0]).alias("symbol"), (F.col("_row") * 2).alias("_at")).union(rows.select(ends[1], F.col("_row") * 2 + 1))
    ids = dense_ids(both, "symbol", "_at")
    nodes = with_fallback(ids, table)
    n = F.broadcast(ids.agg(F.count("*").alias("_n")))
    for side, end in (("s", ends[0]), ("t", ends[1])):
        rows = rows.join(ids.select(F.col("symbol").alias(end), F.col("id").alias(side)), end)
    out = rows.join(n).withColumn("id", (F.col("_n") + F.col("_row")).cast("bigint"))
    return nodes, out.drop("_n", "_row", *ends)


@dataclass
class Adapter:
    """A way from networks to facts: a name, and a function of networks that gives a table of triples (s, p, o, kind, ...)."""

    name: str
    facts: Callable[[Networks], DataFrame]


@dataclass
class Adapters:
    """The adapters that a caller can choose from by name."""

    known: dict[str, Adapter] = field(default_factory=dict)

    def register(self, adapter: Adapter) -> Adapter:
        if adapter.name in self.known:
            raise ValueError(f"{adapter.name} is registered")
        self.known[adapter.name] = adapter
        return adapter

    def run(self, name: str, nets: Networks) -> DataFrame:
        return self.known[name].facts(nets)
