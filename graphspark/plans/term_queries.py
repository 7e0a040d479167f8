"""Queries over systems, scored networks, symbols and terms that are made of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphspark.functions import identifiers as I
from graphspark.operators import patterns, resolve, select, symbols, terms
from graphspark.plans import star
from graphspark.plans import systems as S
from graphspark.plans.convert import RDF, RDFS
from graphspark.plans.registry import query

_B, _V = I.BASE, I.VOCABULARY
_FIELDS = S.Fields("ID")
#: Systems are nations: as many members as customers, some weight and p-value, segments as cohorts with a frequency.
_SYS = """(SELECT n_nationkey AS node, n_nationkey AS k, 'SYS:' || n_nationkey AS identifier, n_name AS label, coalesce(c, 0) AS size, (n_nationkey % 4) / 4.0 AS weight, CASE WHEN n_nationkey % 5 <> 0 THEN (n_nationkey % 5) / 64.0 END AS p_value
    FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON c_nationkey = n_nationkey)"""
_CUT = "(SELECT CAST(avg(size) AS BIGINT) + 1 AS cut FROM " + _SYS + ")"
_COHORTS = f"""(SELECT s.*, seg AS code, CASE WHEN length(seg) % 2 = 0 THEN k / 32.0 END AS frequency FROM {_SYS} s JOIN (SELECT DISTINCT c_nationkey, c_mktsegment AS seg FROM customer WHERE c_custkey % 7 < 3) c ON c.c_nationkey = s.k, {_CUT} WHERE size < cut)"""


def _nodes(spark, d):
    """The systems as nodes (id, v) of a hierarchy, v by full names."""
    nation, customer = star.table(spark, d, "nation"), star.table(spark, d, "customer")
    held = customer.groupBy("c_nationkey").agg(
        F.count("*").alias("_n"), F.array_sort(F.collect_set(F.when(F.col("c_custkey") % 7 < 3, F.col("c_mktsegment")))).alias("_s"), F.array_sort(F.collect_list("c_custkey")).alias("_m"), F.array_join(F.array_sort(F.collect_list("c_name")), " ").alias("_g")
    )
    k = F.col("n_nationkey")
    both = nation.join(held, k == F.col("c_nationkey"), "left")
    rates = F.map_from_entries(F.transform(F.filter(F.coalesce("_s", F.array().cast("array<string>")), lambda s: F.length(s) % 2 == 0), lambda s: F.struct(F.concat(F.lit(_FIELDS.frequency), s), (k / 32.0).cast("string"))))
    plain = {
        "ID": F.concat(F.lit("SYS:"), k.cast("string")), _FIELDS.label: F.col("n_name"), _FIELDS.size: F.coalesce("_n", F.lit(0)).cast("string"), _FIELDS.weight: ((k % 4) / 4.0).cast("string"), _FIELDS.p_value: F.when(k % 5 != 0, (k % 5) / 64.0).cast("string"),
        _FIELDS.cohorts: F.array_join("_s", " "), _FIELDS.members: F.to_json("_m"), _FIELDS.genes: F.col("_g"),
    }
    bag = F.map_filter(F.create_map(*[x for name, v in plain.items() for x in (F.lit(name), v)]), lambda _, v: v.isNotNull())
    return both.select(k.cast("bigint").alias("id"), F.map_concat(bag, rates).alias("v"))


def _systems(spark, d):
    return S.systems(_nodes(spark, d), _FIELDS)


def _cutoff(found):
    return int(found.agg(F.floor(F.round(F.avg("size")))).first()[0]) + 1


_IRI = f"'{_B}SYS-' || k"


@query(f"""SELECT {_IRI} AS s, '{RDF}type' AS p, '{_V}ProteinSystem' AS o, 'iri' AS kind FROM {_SYS} UNION ALL SELECT {_IRI}, '{RDFS}label', label, 'string' FROM {_SYS} UNION ALL SELECT {_IRI}, '{S.DCTERMS}identifier', identifier, 'string' FROM {_SYS}
    UNION ALL SELECT {_IRI}, '{_V}memberCount', CAST(size AS VARCHAR), 'nonNegativeInteger' FROM {_SYS} UNION ALL SELECT {_IRI}, '{_V}selectionWeight', CASE k % 4 WHEN 1 THEN '0.25' WHEN 2 THEN '0.5' ELSE '0.75' END, 'double' FROM {_SYS} WHERE k % 4 <> 0
    UNION ALL SELECT {_IRI}, '{_V}selectionPValue', CASE k % 5 WHEN 1 THEN '0.015625' WHEN 2 THEN '0.03125' WHEN 3 THEN '0.046875' ELSE '0.0625' END, 'double' FROM {_SYS} WHERE k % 5 <> 0""")
def system_rows(spark, d):
    return S.system_facts(_systems(spark, d))


@query(f"SELECT '{_B}SYS-' || n_nationkey AS s, '{S.BIOLINK}part_of' AS p, '{_B}SYS-' || n_regionkey AS o FROM nation WHERE n_nationkey > 4")
def containment_edges(spark, d):
    # The first nations stand for regions.
    edges = star.table(spark, d, "nation").where("n_nationkey > 4").select(F.col("n_regionkey").cast("bigint").alias("s"), F.col("n_nationkey").cast("bigint").alias("t"))
    return S.containment_facts(edges, _systems(spark, d))


@query(f"SELECT {_IRI} AS s, '{S.BIOLINK}has_member' AS p, 'http://purl.uniprot.org/uniprot/C' || c_custkey AS o FROM {_SYS} JOIN customer ON c_nationkey = k, {_CUT} WHERE size < cut AND c_custkey % 2 = 0")
def exploded_members(spark, d):
    found = _systems(spark, d)
    nodes = star.table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("node"), F.concat(F.lit("http://purl.uniprot.org/uniprot/C"), "c_custkey").alias("iri"))
    return S.member_facts(found, nodes, cutoff=_cutoff(found))


def _terms(spark, d):
    segments = star.table(spark, d, "customer").select(F.col("c_mktsegment").alias("code")).distinct().where("code <> 'FURNITURE'")
    return segments.select("code", F.concat(F.lit("http://x.org/t/"), "code").alias("term"), F.lower("code").alias("label"))


@query(f"SELECT identifier, code, CASE WHEN code <> 'FURNITURE' THEN 'http://x.org/t/' || code END AS term, frequency FROM {_COHORTS}")
def cohort_terms(spark, d):
    found = _systems(spark, d)
    return S.cohort_rows(found, _terms(spark, d), _cutoff(found)).select("identifier", "code", "term", "frequency")


_ASSOC = [("type", f"{RDF}type", f"'{S.BIOLINK}Association'"), ("s", f"{S.BIOLINK}subject", _IRI), ("p", f"{S.BIOLINK}predicate", f"'{S.BIOLINK}genetically_associated_with'"), ("k", f"{S.BIOLINK}knowledge_level", f"'{S.BIOLINK}statistical_association'"), ("a", f"{S.BIOLINK}agent_type", f"'{S.BIOLINK}data_analysis_pipeline'"), ("e", f"{S.BIOLINK}has_evidence", f"'{S.EVIDENCE}'")]


def _associations(subject: str, object_: str, rows: str) -> str:
    return " UNION ALL ".join(f"SELECT {subject} AS s, '{p}' AS p, {o} AS o FROM {rows}" for _, p, o in [*_ASSOC, ("o", f"{S.BIOLINK}object", object_)])


@query(_associations(f"{_IRI} || '-' || code", "'http://x.org/t/' || code", f"(SELECT * FROM {_COHORTS} WHERE code <> 'FURNITURE')") + f" UNION ALL SELECT {_IRI} || '-' || code, '{_V}mutatedFraction', CAST(k AS VARCHAR) || '/32' FROM {_COHORTS} WHERE code <> 'FURNITURE' AND frequency IS NOT NULL")
def cohort_associations(spark, d):
    found = _systems(spark, d)
    facts = S.cohort_facts(S.cohort_rows(found, _terms(spark, d), _cutoff(found)))
    # Fractions are compared as such, not by their digits.
    return facts.select("s", "p", F.when(F.col("kind") == "double", F.concat((F.col("o").try_cast("double") * 32).cast("int").cast("string"), F.lit("/32"))).otherwise(F.col("o")).alias("o"))


@query(_associations(f"{_IRI} || '-selection'", f"'{S.CANCER}'", f"(SELECT s.* FROM {_SYS} s, {_CUT} WHERE size < cut AND p_value < 0.05)"))
def significance_associations(spark, d):
    found = _systems(spark, d)
    return S.selection_facts(found, cutoff=_cutoff(found)).select("s", "p", "o")


@query("SELECT c_nationkey AS id, string_agg(c_custkey, ',' ORDER BY c_custkey) AS members, string_agg(c_name, ',' ORDER BY c_custkey) AS names, count(*) + 0 AS found FROM customer WHERE c_custkey % 3 <> 0 AND c_nationkey > 0 GROUP BY 1")
def hierarchy_members(spark, d):
    nodes = _nodes(spark, d)
    # Every nation under nation 0, which is the one root.
    edges = star.table(spark, d, "nation").where("n_nationkey > 0").select(F.lit(0).cast("bigint").alias("s"), F.col("n_nationkey").cast("bigint").alias("t"))
    table = star.table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_name").alias("symbol"), F.col("c_custkey").alias("node"))
    found = S.with_members(nodes, edges, table, _FIELDS).where("NOT is_root AND size(members) > 0")
    return found.select(F.col("id").cast("int").alias("id"), F.array_join("members", ",").alias("members"), F.array_join("member_names", ",").alias("names"), F.size("members").cast("bigint").alias("found"))


#: Scored edges: customers of an order with its supplier, the best of each end beside what is over the floor.
_EDGES = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'P' || l_partkey AS a, 'S' || l_suppkey AS b, l_extendedprice AS score FROM lineitem WHERE l_linenumber = 1)"
_RANKED = f"(SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, l_orderkey, l_partkey, l_suppkey) AS x, row_number() OVER (PARTITION BY b ORDER BY score DESC, l_orderkey, l_partkey, l_suppkey) AS y FROM {_EDGES})"
_KEPT = f"(SELECT *, CASE WHEN score >= 90000 THEN 'core' ELSE 'backbone' END AS role FROM {_RANKED} WHERE score >= 90000 OR x = 1 OR y = 1)"
_ORDER = ["l_orderkey", "l_partkey", "l_suppkey"]


def _scored(spark, d):
    items = star.table(spark, d, "lineitem").where("l_linenumber = 1")
    edges = items.select(*_ORDER, F.concat(F.lit("P"), "l_partkey").alias("a"), F.concat(F.lit("S"), "l_suppkey").alias("b"), F.col("l_extendedprice").alias("score"))
    return select.core_backbone(edges, ["a", "b"], "score", _ORDER, 90000.0)


@query(f"SELECT l_orderkey, a, b, score FROM {_KEPT} WHERE role = 'core'")
def core_only(spark, d):
    return patterns.pure_core(_scored(spark, d)).select("l_orderkey", "a", "b", "score")


@query(f"SELECT l_orderkey, a, b, CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey) - 1 AS BIGINT) AS rank FROM {_KEPT}")
def original_order(spark, d):
    from graphspark.operators.positions import dense_positions

    return dense_positions(_scored(spark, d), _ORDER, "rank").select("l_orderkey", "a", "b", "rank")


_ROWS = f"(SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey) - 1 AS row FROM {_KEPT})"
_SYMS = f"(SELECT symbol, CAST(row_number() OVER (ORDER BY min(pl)) - 1 AS BIGINT) AS id FROM (SELECT a AS symbol, 2 * row AS pl FROM {_ROWS} UNION ALL SELECT b, 2 * row + 1 FROM {_ROWS}) GROUP BY 1)"


def _network(spark, d):
    table = star.table(spark, d, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), "p_partkey").alias("symbol"), F.concat(F.lit("uniprot:P"), "p_partkey").alias("curie"), F.lit("protein").alias("id_type"))
    return S.scored_network(_scored(spark, d), ("a", "b"), table, _ORDER)


_FOUND = "left(symbol, 1) = 'P' AND CAST(substr(symbol, 2) AS BIGINT) % 2 = 0"


@query(f"SELECT id, symbol, CASE WHEN {_FOUND} THEN 'uniprot:' || symbol ELSE 'hgnc.symbol:' || symbol END AS curie, CASE WHEN {_FOUND} THEN 'protein' ELSE 'gene' END AS id_type FROM {_SYMS}")
def fallback_curie(spark, d):
    return _network(spark, d)[0].select("id", "symbol", "curie", "id_type")


@query(f"SELECT (SELECT count(*) FROM {_SYMS}) + row AS id, x.id AS s, y.id AS t, score, role FROM {_ROWS} JOIN {_SYMS} x ON x.symbol = a JOIN {_SYMS} y ON y.symbol = b")
def scored_nodes(spark, d):
    return _network(spark, d)[1].select("id", "s", "t", "score", "role")


_IP = "'http://purl.uniprot.org/uniprot/P' || l_partkey % 40"
_IS = "'http://purl.uniprot.org/uniprot/P' || l_suppkey % 40"


@query(f"""WITH k AS (SELECT *, {_IP} AS s0, {_IS} AS o0 FROM {_ROWS} WHERE l_partkey % 40 <> 7 AND l_suppkey % 40 <> 7), e AS (SELECT *, '{_B}e' || row AS e FROM k WHERE s0 <> o0)
    SELECT s0 AS s, '{S.BIOLINK}interacts_with' AS p, o0 AS o, 'iri' AS kind FROM e UNION ALL SELECT e, '{RDF}type', '{RDF}Statement', 'iri' FROM e UNION ALL SELECT e, '{RDF}subject', s0, 'iri' FROM e
    UNION ALL SELECT e, '{RDF}predicate', '{S.BIOLINK}interacts_with', 'iri' FROM e UNION ALL SELECT e, '{RDF}object', o0, 'iri' FROM e UNION ALL SELECT e, '{_V}associationScore', CAST(CAST(floor(score) AS BIGINT) AS VARCHAR), 'double' FROM e
    UNION ALL SELECT e, '{_V}retainedForConnectivity', 'true', 'boolean' FROM e WHERE role = 'backbone'""")
def scored_facts(spark, d):
    # Proteins share accessions, and one accession does not resolve: loops and ends without an IRI fall away.
    from graphspark.operators.positions import dense_positions

    rows = dense_positions(_scored(spark, d), _ORDER, "row")
    ends = rows.select((F.col("l_partkey") % 40).alias("k")).union(rows.select(F.col("l_suppkey") % 40)).distinct()
    bag = lambda c: F.create_map(F.lit("represents"), F.concat(F.when(F.col(c) == 7, "nope:P").otherwise("uniprot:P"), F.col(c).cast("string")), F.lit("name"), F.col(c).cast("string"), F.lit("type"), F.lit("protein"))
    nodes = S.network_nodes(ends.select(F.col("k").cast("bigint").alias("id"), bag("k").alias("v")), F.create_map().cast("map<string,string>"))
    edges = rows.select(F.col("row").alias("id"), (F.col("l_partkey") % 40).alias("s"), (F.col("l_suppkey") % 40).alias("t"), F.create_map(F.lit("integrated_score"), F.floor("score").cast("string"), F.lit(S.ROLE), F.col("role")).alias("v"))
    facts = S.network_facts(nodes.where("false"), S.interactions(edges, nodes))
    return facts.select("s", "p", F.when(F.col("kind") == "double", F.regexp_replace("o", r"\.0$", "")).otherwise(F.col("o")).alias("o"), "kind")


#: A reference table of symbols: parts by brand and size.
_REF = """(SELECT p_partkey, 'G' || p_partkey AS symbol, 'HGNC:' || p_partkey AS gene, CASE WHEN p_partkey % 10 = 0 THEN 'Retired' ELSE 'Approved' END AS status, CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'A' || p_partkey ELSE 'A' || p_partkey || '|B' || p_partkey END AS acc,
    CASE WHEN p_partkey % 4 = 0 THEN 'OLD' || p_partkey % 50 ELSE '' END AS prev, CASE WHEN p_partkey % 5 = 0 THEN 'ALIAS' || p_partkey % 60 || '|X' ELSE '' END AS alias FROM part)"""
_ASKED = """(SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN 'G' || c_custkey // 5 WHEN 1 THEN 'OLD' || c_custkey % 50 WHEN 2 THEN 'ALIAS' || c_custkey % 60 WHEN 3 THEN 'W' || c_custkey % 9 ELSE 'C' || c_custkey % 7 END AS symbol FROM customer)"""


def _resolved(spark, d):
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    acc = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("A"), text)).otherwise(F.concat(F.lit("A"), text, F.lit("|B"), text))
    table = star.table(spark, d, "part").orderBy("p_partkey").coalesce(1).select(
        F.concat(F.lit("G"), text).alias("symbol"), F.concat(F.lit("HGNC:"), text).alias("hgnc_id"), F.when(k % 10 == 0, "Retired").otherwise("Approved").alias("status"), acc.alias("uniprot_ids"),
        F.when(k % 4 == 0, F.concat(F.lit("OLD"), (k % 50).cast("string"))).otherwise("").alias("prev_symbol"), F.when(k % 5 == 0, F.concat(F.lit("ALIAS"), (k % 60).cast("string"), F.lit("|X"))).alias("alias_symbol"),
    )
    c, ct = F.col("c_custkey"), lambda m: (F.col("c_custkey") % m).cast("string")
    asked = F.when(c % 5 == 0, F.concat(F.lit("G"), F.floor(c / 5).cast("string"))).when(c % 5 == 1, F.concat(F.lit("OLD"), ct(50))).when(c % 5 == 2, F.concat(F.lit("ALIAS"), ct(60))).when(c % 5 == 3, F.concat(F.lit("W"), ct(9))).otherwise(F.concat(F.lit("C"), ct(7)))
    found = symbols.symbols(star.table(spark, d, "customer").select(asked.alias("symbol")), ["symbol"])
    withdrawn = found.where(F.col("symbol").isin("W1", "W2", "W3")).select("symbol", F.concat(F.lit("HGNC:9"), F.substr("symbol", F.lit(2))).alias("gene"))
    cache = found.where(F.col("symbol").isin("C1", "C2", "W2")).select("symbol", F.array(F.concat(F.lit("Z"), "symbol")).alias("accessions"), F.lit("landed").alias("route"))
    return symbols.resolve(found, symbols.reference(table, withdrawn), cache)


_RES = f"""(WITH r AS (SELECT * FROM {_REF} WHERE status = 'Approved'), p AS (SELECT prev AS symbol, count(*) FILTER (acc <> '') AS n, arg_min(acc, p_partkey) FILTER (acc <> '') AS acc, arg_min(gene, p_partkey) AS gene FROM r WHERE prev <> '' GROUP BY 1),
    a AS (SELECT split_part(alias, '|', 1) AS symbol, count(*) FILTER (acc <> '') AS n, arg_min(acc, p_partkey) FILTER (acc <> '') AS acc FROM r WHERE alias <> '' GROUP BY 1),
    q AS (SELECT x.symbol, nullif(r.acc, '') AS a0, p.acc AS a1, p.n AS n1, a.acc AS a2, a.n AS n2, CASE WHEN x.symbol IN ('C1', 'C2', 'W2') THEN 'Z' || x.symbol END AS a3, coalesce(r.gene, p.gene, CASE WHEN x.symbol IN ('W1', 'W2', 'W3') THEN 'HGNC:9' || substr(x.symbol, 2) END) AS gene
      FROM {_ASKED} x LEFT JOIN r ON r.symbol = x.symbol LEFT JOIN p ON p.symbol = x.symbol LEFT JOIN a ON a.symbol = x.symbol)
    SELECT symbol, CASE WHEN a0 IS NOT NULL THEN 'approved_symbol' WHEN a1 IS NOT NULL THEN 'prev_symbol' || CASE WHEN n1 > 1 THEN '_ambiguous' ELSE '' END WHEN a2 IS NOT NULL THEN 'alias_symbol' || CASE WHEN n2 > 1 THEN '_ambiguous' ELSE '' END WHEN a3 IS NOT NULL THEN 'landed'
      WHEN gene IS NOT NULL THEN 'hgnc_id_fallback' ELSE 'hgnc_symbol_fallback' END AS route, coalesce('uniprot:' || split_part(coalesce(a0, a1, a2, a3), '|', 1), 'hgnc:' || split_part(gene, ':', 2), 'hgnc.symbol:' || symbol) AS curie, coalesce(a0, a1, a2, a3) AS acc FROM q)"""


@query(f"SELECT symbol, curie, route, CASE WHEN acc IS NULL THEN 'gene' ELSE 'protein' END AS id_type, coalesce(acc, '') AS accessions FROM {_RES}")
def symbol_resolution(spark, d):
    return _resolved(spark, d).select("symbol", "curie", "route", "id_type", F.array_join("accessions", "|").alias("accessions"))


@query(f"SELECT count(*) AS symbols, count(acc) AS proteins, count(*) - count(acc) AS genes, count(DISTINCT curie) FILTER (acc IS NOT NULL) AS accessions, count(acc) - count(DISTINCT curie) FILTER (acc IS NOT NULL) AS lost FROM {_RES}")
def distinct_loss(spark, d):
    return symbols.report(_resolved(spark, d))


@query(f"SELECT curie, count(*) AS n, string_agg(symbol, ' ' ORDER BY symbol) AS symbols FROM {_RES} WHERE acc IS NOT NULL GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, curie LIMIT 40")
def shared_identifiers(spark, d):
    return symbols.shared_identifiers(_resolved(spark, d)).select("curie", "n", F.array_join("symbols", " ").alias("symbols"))


@query(f"SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) - 1 AS BIGINT) AS rank FROM {_ASKED}")
def distinct_sorted(spark, d):
    from graphspark.operators.positions import dense_positions

    return dense_positions(_resolved(spark, d).select("symbol"), ["symbol"], "rank")


@query("SELECT p_type, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY n DESC, p_type LIMIT 3")
def top_routes(spark, d):
    return select.top_groups(star.table(spark, d, "part").where("p_size > 10"), ["p_type"], 3)


@query("SELECT 'G' || p_partkey AS symbol FROM part WHERE p_size <> 7 AND p_brand <> 'Brand#1'")
def status_filter(spark, d):
    parts = star.table(spark, d, "part").select(F.concat(F.lit("G"), "p_partkey").alias("symbol"), F.when((F.col("p_size") == 7) | (F.col("p_brand") == "Brand#1"), "Withdrawn").otherwise("Approved").alias("status"))
    none = F.lit("")
    return symbols.reference(parts.select("symbol", none.alias("hgnc_id"), "status", none.alias("uniprot_ids"), none.alias("prev_symbol"), none.alias("alias_symbol"))).approved.select("symbol")


@query("SELECT o_orderkey, string_agg(l_partkey, ' ' ORDER BY i) AS found FROM (SELECT o_orderkey, l_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey) WHERE l_partkey % 3 <> 0 GROUP BY 1")
def canonical_first(spark, d):
    # Members in the order of their list, looked up; the missing ones fall away.
    pairs = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")), asc=False)
    lists = star.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(pairs, lambda x: x["l_partkey"]).alias("parts"))
    parts = star.table(spark, d, "part").where("p_partkey % 3 <> 0").select("p_partkey", F.col("p_partkey").cast("string").alias("name"))
    found = resolve.members(lists.join(star.table(spark, d, "orders").select("o_orderkey"), "o_orderkey", "left_semi"), "parts", parts, ["o_orderkey"], "found")
    return found.where(F.size("found") > 0).select("o_orderkey", F.array_join("found", " ").alias("found"))


@query("SELECT c_custkey, string_agg(s, ' ' ORDER BY s) AS codes FROM (SELECT c_custkey, unnest(string_split(c_mktsegment || ' ' || 'X' || c_custkey % 3 || ' A', ' ')) AS s FROM customer) GROUP BY 1")
def sorted_codes(spark, d):
    text = F.concat(F.lit(" "), "c_mktsegment", F.lit("  X"), (F.col("c_custkey") % 3).cast("string"), F.lit(" A "))
    return star.table(spark, d, "customer").select("c_custkey", F.array_join(F.array_sort(S.words(text)), " ").alias("codes"))


@query("SELECT o_custkey, count(*) AS n FROM (SELECT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'A' INTERSECT SELECT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R') GROUP BY 1")
def shared_sets(spark, d):
    items = star.table(spark, d, "lineitem").join(star.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    own = lambda flag: F.collect_set(F.when(F.col("l_returnflag") == flag, F.col("l_partkey")))
    both = items.groupBy("o_custkey").agg(F.array_intersect(own("A"), own("R")).alias("_both"))
    return both.select("o_custkey", F.size("_both").cast("bigint").alias("n")).where("n > 0")


#: Cohorts are brands; searching for one gives parts of the brand; a part is a term with a label, synonyms and a reference.
_CAND = """(SELECT brand, term, label, min(rank) AS rank FROM (SELECT p_brand AS brand, 'T:' || p_partkey AS term, p_name || ' ' || p_partkey AS label, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank, p_partkey FROM part) WHERE rank <= 8 GROUP BY 1, 2, 3)"""
_TIER = """CASE WHEN k % 7 = 0 THEN 2 WHEN k % 5 = 0 THEN 3 WHEN k % 3 = 0 THEN 4 WHEN k % 2 = 0 THEN 5 END"""


@query(f"""WITH c AS (SELECT *, CAST(substr(term, 3) AS BIGINT) AS k FROM {_CAND}), v AS (SELECT *, {_TIER} AS tier FROM c WHERE k % 11 <> 0), b AS (SELECT brand, min(tier) AS best FROM v WHERE tier IS NOT NULL GROUP BY 1),
    t AS (SELECT v.brand, arg_min(term, rank) AS term, max(tier) AS tier, string_agg(term, ' ' ORDER BY rank) AS all_ FROM v JOIN b ON b.brand = v.brand AND best = tier GROUP BY 1)
    SELECT p.brand AS code, t.term, CASE t.tier WHEN 2 THEN 'oncotree_xref' WHEN 3 THEN 'exact_synonym' WHEN 4 THEN 'exact_label' WHEN 5 THEN 'synonym_match' ELSE 'unresolved' END AS route, coalesce(trim(substr(all_, length(t.term) + 1)), '') AS alternatives
    FROM (SELECT DISTINCT p_brand AS brand FROM part) p LEFT JOIN t ON t.brand = p.brand""")
def candidate_tiers(spark, d):
    from pyspark.sql import Window as W

    part, k = star.table(spark, d, "part"), F.col("p_partkey")
    term = F.concat(F.lit("T:"), k.cast("string"))
    cohorts = part.select(F.col("p_brand").alias("code")).distinct().select("code", F.array(F.concat(F.lit(" the "), "code"), F.lit(" ")).alias("searched"), F.lit("").alias("override"))
    ranked = part.withColumn("_r", F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey"))).where("_r <= 12")
    searches = ranked.groupBy(F.col("p_brand").alias("query")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", term.alias("t")))), lambda x: x["t"]).alias("terms"))
    none = F.lit(None).cast("string")
    wanted = F.concat(F.lit("THE "), "p_brand")
    known = part.select(
        term.alias("term"), F.when(k % 3 == 0, F.concat(wanted, F.lit(" "))).otherwise("other").alias("label"), F.array(none, F.when(k % 5 == 0, F.lower("p_brand")), F.when(k % 2 == 0, wanted), F.lit("")).alias("synonyms"),
        F.array(F.struct(F.lit("ICD").alias("database"), F.col("p_brand").alias("id")), F.struct(F.lit("OncoTree").alias("database"), F.when(k % 7 == 0, F.lower("p_brand")).otherwise("no").alias("id"))).alias("xrefs"), (k % 11 == 0).alias("obsolete"),
    )
    return terms.resolve(cohorts, searches, known).select("code", "term", "route", "alternatives")


@query(f"SELECT '{_V}' || x AS s, count(*) + 0 AS n FROM (VALUES ('ProteinSystem'), ('ProteinSystem'), ('ProteinSystem'), ('ProteinSystem'), ('ProteinSystem')) t(x) GROUP BY 1 UNION ALL SELECT '{_V}' || x, n FROM (VALUES ('memberCount', 7), ('mutatedFraction', 7), ('selectionWeight', 7), ('selectionPValue', 8), ('associationScore', 6), ('retainedForConnectivity', 6)) t(x, n)")
def vocabulary_rows(spark, d):
    return S.vocabulary_rows(spark).groupBy("s").agg(F.count("*").alias("n"))


@query(f"""SELECT '{_B}kg' AS s, p, o FROM (VALUES ('{RDF}type', '{S.VOID}Dataset'), ('{RDF}type', '{S.PROV}Entity'), ('{S.DCTERMS}title', 'Graph'), ('{S.DCTERMS}description', 'Of tables'), ('{S.DCTERMS}created', '2024-05-06'), ('{S.PAV}version', '1.0'),
    ('{S.PROV}wasDerivedFrom', 'http://x.org/1'), ('{S.PROV}wasDerivedFrom', 'http://x.org/2'), ('{S.PROV}wasGeneratedBy', '_:activity')) t(p, o) UNION ALL SELECT '_:activity', p, o FROM (VALUES ('{RDF}type', '{S.PROV}Activity'), ('{S.PAV}version', 'graphspark')) t(p, o)""")
def provenance_rows(spark, d):
    return S.provenance_rows(spark, "kg", "Graph", "Of tables", "1.0", ["http://x.org/1", "http://x.org/2"], "2024-05-06").select("s", "p", "o")
