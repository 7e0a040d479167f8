"""The registered queries over the star schema seen as a property graph, each with its DuckDB counterpart.

Customers, suppliers, parts, nations and regions are nodes; line items are scored, evidenced interactions; orders are
pathways that parts participate in; regions contain nations, which contain customers.
"""

from __future__ import annotations

import importlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphspark.functions import chemicals as C
from graphspark.functions import evidence as E
from graphspark.functions import identifiers as I
from graphspark.operators import dedup, hierarchy, patterns, positions, resolve, select
from graphspark.plans import registry
from graphspark.plans.registry import query

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """Line items as interactions: subject (customer), object (supplier), part, score, n, edge number, order."""
    orders = _table(spark, d, "orders").select("o_orderkey", "o_custkey")
    items = _table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return items.select(
        F.col("o_custkey").alias("subject"), F.col("l_suppkey").alias("object"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("score"), F.col("l_quantity").cast("bigint").alias("n"),
        F.col("l_linenumber").alias("line"), F.col("l_orderkey").alias("pathway"), "l_returnflag",
    )


_F = "(SELECT o_custkey AS subject, l_suppkey AS object, l_partkey AS part, l_extendedprice AS score, CAST(l_quantity AS BIGINT) AS n, l_linenumber AS line, l_orderkey AS pathway, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
# Event types as relation types, and what they map to.
_KINDS = {"click": "Activation", "view": "Complex", "purchase": "Phosphorylation", "signup": "Inhibition"}


def _sql_map(column: str, values: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE {default} END"


@query(f"SELECT subject, object, CAST(sum(n) AS BIGINT) AS evidence FROM {_F} GROUP BY 1, 2")
def interaction_totals(spark, d):
    return _facts(spark, d).groupBy("subject", "object").agg(F.sum("n").alias("evidence"))


@query("SELECT l_orderkey, l_linenumber, c_name AS source_value, s_name AS target_value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey")
def endpoint_resolution(spark, d):
    nodes = _table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")).alias("id"), F.col("c_name").alias("name")).union(_table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")), "s_name"))
    items = _table(spark, d, "lineitem").join(_table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    edges = items.select("l_orderkey", "l_linenumber", F.concat(F.lit("c"), F.col("o_custkey")).alias("a"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("b"))
    return resolve.endpoints(edges, nodes, "a", "b", "id", "name").drop("a", "b")


@query("""WITH f AS (SELECT p_type, min(p_partkey) AS first FROM part GROUP BY 1)
    SELECT p_partkey, coalesce(first, p_partkey) AS resolved FROM part LEFT JOIN f ON replace(part.p_type, 'ECONOMY', 'NONE') = f.p_type""")
def first_name_fallback(spark, d):
    parts = _table(spark, d, "part").select("p_partkey", "p_type")
    first = resolve.first_by(parts, ["p_type"], ["p_partkey"]).select("p_type", "p_partkey")
    named = parts.withColumn("name", F.replace("p_type", F.lit("ECONOMY"), F.lit("NONE"))).drop("p_type")
    return resolve.lookup(named, first, "name", "p_partkey", F.col("p_partkey"), "resolved").select("p_partkey", "resolved")


@query(f"SELECT event_id, {_sql_map('event_type', {'click': I.TYPE_CLASS['protein'], 'view': I.TYPE_CLASS['gene'], 'purchase': I.TYPE_CLASS['drug']})} AS class FROM events")
def class_routing(spark, d):
    kind = F.try_element_at(I.literal_map({"click": "Protein", "view": "GENE", "purchase": "drug"}), "event_type")
    return _table(spark, d, "events").select("event_id", I.type_class(kind, F.lit("none:1")).alias("class"))


@query("SELECT event_id, " + _sql_map("event_type", {k: E.TYPE_PREDICATE[v] for k, v in _KINDS.items()}, f"'{E.DEFAULT_PREDICATE}'") + " AS predicate, " + _sql_map("event_type", {"purchase": E.TYPE_PROCESS["Phosphorylation"]}) + " AS process, " + _sql_map("event_type", {"click": "activates", "view": "binds", "purchase": "phosphorylates", "signup": "inhibits"}, "'interacts with'") + " AS verb FROM events")
def default_mapping(spark, d):
    kind = F.coalesce(F.try_element_at(I.literal_map(_KINDS), "event_type"), F.lit("Gef"))
    return _table(spark, d, "events").select("event_id", E.predicate_iri(kind).alias("predicate"), E.process_iri(kind).alias("process"), E.verb_label(kind).alias("verb"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS key_value, 'none' AS colour, event_type AS other FROM events")
def attribute_normalize(spark, d):
    from graphspark.sources.cx2 import normalize

    declared = F.lit(None).cast("map<string,struct<d:string,a:string,v:string>>")
    declared = F.coalesce(declared, F.from_json(F.lit('{"key_value":{"d":"long","a":"k"},"colour":{"v":"none"}}'), "map<string,struct<d:string,a:string,v:string>>"))
    bag = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("other"), F.col("event_type")))
    v = normalize(bag, declared)
    return _table(spark, d, "events").select("event_id", v["key_value"].alias("key_value"), v["colour"].alias("colour"), v["other"].alias("other"))


@query("""SELECT c_custkey, 'http://x.org/c/' || c_custkey AS exact, 'http://x.org/c/' || c_custkey AS near, 'who:' || c_custkey AS unknown, 'cust:' || c_custkey AS compacted FROM customer""")
def curie_expand_compact(spark, d):
    p, key = I.literal_map({"cust": "http://x.org/c/", "nat": "http://x.org/n/"}), F.col("c_custkey").cast("string")
    curie = lambda prefix: I.expand(F.concat(F.lit(f"{prefix}:"), key), p)
    return _table(spark, d, "customer").select("c_custkey", curie("cust").alias("exact"), curie("CUST").alias("near"), curie("who").alias("unknown"), I.compact(F.concat(F.lit("http://x.org/c/"), key), p).alias("compacted"))


@query("""SELECT p_partkey, regexp_replace(regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
    replace(replace(replace(p_name || ' {' || p_type, ' ', '%20'), '{', '%7B'), '|', '%7C') AS iri FROM part""")
def slug_and_safe_iri(spark, d):
    return _table(spark, d, "part").select("p_partkey", I.slugify(F.concat_ws(" ", "p_name", "p_type")).alias("slug"), I.safe_iri(F.concat("p_name", F.lit(" {"), "p_type")).alias("iri"))


@query(f"""WITH m AS (SELECT r_name, string_agg(lower(trim(n_name)), '|' ORDER BY lower(trim(n_name))) AS s FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
    SELECT r_name, '{I.BASE}family/' || regexp_replace(r_name, '[^A-Za-z0-9]+', '-', 'g') || '-' || printf('%08x',
    list_reduce(list_prepend(2166136261::BIGINT, list_transform(string_split(s, ''), lambda x: ascii(x)::BIGINT)), lambda h, c: (xor(h, c) * 16777619) % 4294967296)) AS iri FROM m""")
def family_identity(spark, d):
    names = _table(spark, d, "nation").join(_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return names.groupBy("r_name").agg(F.collect_list("n_name").alias("m")).select("r_name", I.family_iri(F.col("r_name"), F.col("m")).alias("iri"))


@query("""SELECT page_id, CAST(i - 1 AS INTEGER) AS idx, regexp_extract(m[i], 'href="([^"]*)"', 1) AS href
    FROM (SELECT page_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="[^"]*"') AS m FROM pages))""")
def html_items(spark, d):
    found = F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))
    return _table(spark, d, "pages").select("page_id", F.posexplode(found).alias("idx", "href"))


@query("SELECT page_id, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source, nullif(regexp_extract(url, '[?&]id=([^&#]*)', 1), '') AS id FROM pages")
def url_params(spark, d):
    return _table(spark, d, "pages").select("page_id", E.url_parameter(F.col("url"), "utm_source").alias("utm_source"), E.url_parameter(F.col("url"), "id").alias("id"))


# Two items a row: by URL with a space and an encoded mark, and by text, or one that neither states; the third is none.
_ITEMS = """(SELECT o_orderkey, 0 AS pos, 'Customer ' || o_custkey AS subject, 'Order' || o_orderkey AS object, 'Phosphorylation' AS kind, o_custkey AS n FROM orders
    UNION ALL SELECT o_orderkey, 1, 'c' || o_custkey, 'o' || o_orderkey, 'IncreaseAmount', 7 FROM orders WHERE o_orderkey % 3 = 0)"""


def _order_html() -> Column:
    c, o = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    link = lambda text, url, n: F.concat(F.lit("<li/>"), text, F.lit('(<a href="'), url, F.lit('" target="_blank">'), n, F.lit("</a>)"))
    by_url = link(F.lit("any (text)"), F.concat(F.lit("https://x.org/a?subject=Customer "), c, F.lit("&object=Or%64er"), o, F.lit("&type=Phosphorylation#x")), c)
    told = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("c"), c, F.lit(" Increases the amount of o"), o)).otherwise("says nothing")
    return F.concat(F.lit("<ul>"), by_url, F.lit("<br>"), link(told, F.lit("https://x.org/a?subject=3&#x27;5&object=o&type=Complex"), F.lit("7")), F.lit("</ul>"))


@query(f"SELECT o_orderkey, pos, subject, object, kind, n FROM {_ITEMS}")
def evidence_items(spark, d):
    return E.exploded(_table(spark, d, "orders"), _order_html(), "o_orderkey").select("o_orderkey", F.col("i").alias("pos"), "r.subject", "r.object", "r.kind", "r.n")


@query("SELECT o_orderkey, o_custkey + 7 AS total, 2 AS urls, '<li/>any (text)(<a href=\"https://x.org/a?subject=Customer ' || o_custkey || '&object=Or%64er' || o_orderkey || '&type=Phosphorylation#x\">' || o_custkey || '</a>)' AS head FROM orders")
def slim_items(spark, d):
    rows = _table(spark, d, "orders").select("o_orderkey", _order_html().alias("h"))
    slim = E.slim(F.col("h"))
    return rows.select("o_orderkey", E.total_evidence(F.col("h")).alias("total"), F.size(E.evidence_urls(F.col("h"))).alias("urls"), F.concat(F.substring_index(slim, "</a>)", 1), F.lit("</a>)")).alias("head"))


@query("""SELECT 'nation' || n_nationkey AS s, 'in' AS p, 'region' || n_regionkey AS o FROM nation UNION SELECT 'cust' || c_custkey, 'in', 'nation' || c_nationkey FROM customer
    UNION SELECT 'supp' || l_suppkey, 'sells', 'part' || l_partkey FROM lineitem""")
def distinct_triples(spark, d):
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c))
    a = _table(spark, d, "nation").select(name("nation", "n_nationkey").alias("s"), F.lit("in").alias("p"), name("region", "n_regionkey").alias("o"))
    b = _table(spark, d, "customer").select(name("cust", "c_custkey"), F.lit("in"), name("nation", "c_nationkey"))
    c = _table(spark, d, "lineitem").select(name("supp", "l_suppkey"), F.lit("sells"), name("part", "l_partkey"))
    return a.union(b).union(c).distinct()


@query("""SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS segment, arg_min(c_name, c_custkey) FILTER (c_acctbal > 0) AS label,
    string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS aliases FROM customer GROUP BY 1""")
def declaration_merge(spark, d):
    c = _table(spark, d, "customer").withColumn("_label", F.when(F.col("c_acctbal") > 0, F.col("c_name")))
    first = dedup.first_values(c, "c_nationkey", ["c_mktsegment", "_label"], ["c_custkey"]).withColumnsRenamed({"c_mktsegment": "segment", "_label": "label"})
    aliases = c.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("aliases"))
    return first.join(aliases, "c_nationkey")


@query("SELECT min(l_orderkey * 10 + l_linenumber) AS first, l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY 2, 3, 4")
def content_dedup(spark, d):
    rows = _table(spark, d, "lineitem").withColumn("first", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return dedup.content_first(rows, ["l_suppkey", "l_returnflag", "l_linestatus"], ["first"]).select("first", "l_suppkey", "l_returnflag", "l_linestatus")


_N = f"(SELECT c_nationkey AS a, s_nationkey AS b, n, pathway * 10 + line AS ord FROM {_F} JOIN customer ON subject = c_custkey JOIN supplier ON object = s_suppkey)"


def _nation_edges(spark, d):
    c, s = _table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("a")), _table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("b"))
    f = _facts(spark, d)
    return f.join(c, F.col("subject") == F.col("c_custkey")).join(s, F.col("object") == F.col("s_suppkey")).select("a", "b", "n", (F.col("pathway") * 10 + F.col("line")).alias("ord"))


# Edges of nation pairs, the first of each order, and two items of each third one, which may name other nations.
_PAIRS = f"(SELECT ord AS pos, min(a) AS s, min(b) AS t FROM {_N} WHERE ord % 50 = 1 GROUP BY 1)"
_SAID = f"""(SELECT pos, 0 AS i, 'x' || pos % 4 AS item, CASE WHEN pos % 2 = 0 THEN s ELSE t END AS ds, CASE WHEN pos % 2 = 0 THEN t ELSE s END AS dt FROM {_PAIRS} WHERE pos % 3 <> 0
    UNION ALL SELECT pos, 1, 'y' || pos % 2, s, CAST(NULL AS INTEGER) FROM {_PAIRS} WHERE pos % 3 = 1)"""


@query(f"""WITH e AS (SELECT * FROM {_PAIRS}), w AS (SELECT *, least(s, t) AS low, greatest(s, t) AS high FROM e),
    p AS (SELECT low, high, min(pos) AS pair_pos, count(*) AS n, arg_min(s, pos) AS s0, arg_min(t, pos) AS t0 FROM w GROUP BY 1, 2),
    j AS (SELECT w.pos, w.low, w.high, pair_pos, coalesce(i, -1) AS i, item, CASE WHEN ds IS NULL OR dt IS NULL THEN s0 ELSE ds END AS a, CASE WHEN ds IS NULL OR dt IS NULL THEN t0 ELSE dt END AS b
          FROM w JOIN p ON w.low = p.low AND w.high = p.high AND n > 1 LEFT JOIN {_SAID} x ON x.pos = w.pos),
    k AS (SELECT low, high, pair_pos, a, b, min(pos * 10 + i + 1) AS place, arg_min(pos, pos * 10 + i + 1) AS edge FROM j GROUP BY 1, 2, 3, 4, 5),
    f AS (SELECT low, high, a, b, string_agg(item, ',' ORDER BY pl) AS found FROM (SELECT low, high, a, b, item, min(pos * 10 + i + 1) AS pl FROM j WHERE item IS NOT NULL GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4),
    r AS (SELECT e.s, e.t, pair_pos, place, edge, coalesce(found, '') AS found FROM k JOIN e ON e.pos = k.edge LEFT JOIN f ON f.low = k.low AND f.high = k.high AND f.a = k.a AND f.b = k.b
          UNION ALL SELECT w.s, w.t, pair_pos, w.pos * 10, w.pos, '-' FROM w JOIN p ON w.low = p.low AND w.high = p.high AND n = 1)
    SELECT CAST(row_number() OVER (ORDER BY pair_pos, place) - 1 AS BIGINT) AS id, s, t, edge, found FROM r""")
def directed_collapse(spark, d):
    edges = _nation_edges(spark, d).where("ord % 50 = 1").groupBy(F.col("ord").alias("pos")).agg(F.min("a").alias("s"), F.min("b").alias("t"))
    ends = lambda a, b: F.when(F.col("pos") % 2 == 0, F.col(a)).otherwise(F.col(b))
    one = edges.where("pos % 3 <> 0").select("pos", F.lit(0).alias("i"), F.concat(F.lit("x"), F.col("pos") % 4).alias("item"), ends("s", "t").alias("ds"), ends("t", "s").alias("dt"))
    two = edges.where("pos % 3 = 1").select("pos", F.lit(1).alias("i"), F.concat(F.lit("y"), F.col("pos") % 2).alias("item"), F.col("s").alias("ds"), F.lit(None).cast("int").alias("dt"))
    found = positions.dense_positions(dedup.collapse_by_direction(edges, one.union(two)), ["pair_pos", "place"], "id")
    said = F.when(F.col("single"), "-").otherwise(F.coalesce(F.array_join("found", ","), F.lit("")))
    return found.select("id", "s", "t", "edge", said.alias("found"))


@query(f"SELECT least(a, b) AS low, greatest(a, b) AS high, count(*) AS n FROM {_N} GROUP BY 1, 2 HAVING count(*) > 50")
def pair_limit(spark, d):
    return dedup.pair_limit(_nation_edges(spark, d), "a", "b", 50)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS a,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem)
    SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice >= 80000 THEN 'core' ELSE 'backbone' END AS role FROM r WHERE l_extendedprice >= 80000 OR a = 1 OR b = 1""")
def core_backbone(spark, d):
    items = _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return select.core_backbone(items, ["l_partkey", "l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 80000.0).select("l_orderkey", "l_linenumber", "role")


@query("SELECT l_partkey, CAST(row_number() OVER (ORDER BY f, l_partkey) - 1 AS BIGINT) AS id FROM (SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS f FROM lineitem GROUP BY 1)")
def dense_ids(spark, d):
    rows = _table(spark, d, "lineitem").select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    return dedup.dense_ids(rows, "l_partkey", "ord")


@query("SELECT DISTINCT l_partkey AS s, 'participates' AS p, l_orderkey AS o FROM lineitem")
def membership_flip(spark, d):
    return _table(spark, d, "lineitem").select(F.col("l_partkey").alias("s"), F.lit("participates").alias("p"), F.col("l_orderkey").alias("o")).distinct()


@query("""WITH m AS (SELECT DISTINCT l_partkey AS member, l_orderkey AS grp FROM lineitem), p AS (SELECT p_partkey AS a, p_partkey + 1 AS b FROM part)
    SELECT p.a, p.b, x.grp AS "group" FROM p JOIN m x ON x.member = p.a JOIN m y ON y.member = p.b AND y.grp = x.grp""")
def shared_groups(spark, d):
    members = _table(spark, d, "lineitem").select(F.col("l_partkey").alias("member"), F.col("l_orderkey").alias("group")).distinct()
    pairs = _table(spark, d, "part").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    return patterns.shared_groups(pairs, members)


def _contained(spark, d):
    n, c = _table(spark, d, "nation"), _table(spark, d, "customer")
    return n.select(F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.concat(F.lit("n"), "n_nationkey").alias("child")).union(c.select(F.concat(F.lit("n"), "c_nationkey"), F.concat(F.lit("c"), "c_custkey")))


_C = "(SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer)"


@query(f"SELECT DISTINCT parent AS node FROM {_C} WHERE parent NOT IN (SELECT child FROM {_C})")
def root_nodes(spark, d):
    return hierarchy.roots(_contained(spark, d))


@query(f"WITH RECURSIVE e AS (SELECT * FROM {_C}), t(ancestor, descendant) AS (SELECT parent, child FROM e UNION SELECT t.ancestor, e.child FROM t JOIN e ON t.descendant = e.parent) SELECT ancestor, descendant FROM t")
def hierarchy_closure(spark, d):
    return hierarchy.closure(_contained(spark, d))


@query("""SELECT 'r' || n_regionkey AS ancestor, c_mktsegment AS member FROM nation JOIN customer ON c_nationkey = n_nationkey
    UNION SELECT 'n' || c_nationkey, c_mktsegment FROM customer UNION SELECT 'c' || c_custkey, c_mktsegment FROM customer""")
def descendant_union(spark, d):
    members = _table(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.col("c_mktsegment").alias("member"))
    return hierarchy.held_by_descendants(hierarchy.closure(_contained(spark, d)), members)


@query("SELECT c_nationkey AS system, c_custkey AS member FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) < 60)")
def payload_cutoff(spark, d):
    c = _table(spark, d, "customer")
    small = select.with_payload(c.groupBy("c_nationkey").count(), "count", 60).select("c_nationkey")
    return c.join(small, "c_nationkey").select(F.col("c_nationkey").alias("system"), F.col("c_custkey").alias("member"))


@query(f"SELECT subject AS a, object AS b FROM {_F} UNION SELECT object, subject FROM {_F}")
def symmetric_partners(spark, d):
    return patterns.symmetric(_facts(spark, d), "subject", "object")


@query(f"SELECT subject AS entity FROM {_F} UNION SELECT object FROM {_F}")
def participants_union(spark, d):
    return patterns.participants(_facts(spark, d), "subject", "object")


@query(f"SELECT pathway, line, subject, object, n FROM {_F} WHERE n > 40")
def evidence_threshold(spark, d):
    return _facts(spark, d).where("n > 40").select("pathway", "line", "subject", "object", "n")


@query(f"SELECT DISTINCT c_name AS subject_label, s_name AS object_label, n FROM {_F} JOIN customer ON subject = c_custkey JOIN supplier ON object = s_suppkey WHERE l_returnflag = 'R'")
def partner_labels(spark, d):
    f = _facts(spark, d).where("l_returnflag = 'R'")
    c, s = _table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("subject_label")), _table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("object_label"))
    return f.join(c, F.col("subject") == F.col("c_custkey")).join(s, F.col("object") == F.col("s_suppkey")).select("subject_label", "object_label", "n").distinct()


@query(f"SELECT subject, object FROM {_F} UNION SELECT subject, object + 100000 FROM {_F} WHERE object % 2 = 0")
def alias_expanded_join(spark, d):
    aliases = _table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("name"), (F.col("s_suppkey") + 100000).alias("alias"))
    return patterns.expanded_by_alias(_facts(spark, d).select("subject", "object"), aliases, "object")


@query("""WITH a AS (SELECT p_brand AS k, min(p_partkey) AS v, count(*) AS n FROM part WHERE p_size < 5 GROUP BY 1), b AS (SELECT p_brand AS k, min(p_partkey) AS v, count(*) AS n FROM part WHERE p_size >= 20 GROUP BY 1)
    SELECT p_partkey, coalesce(a.v, b.v) AS resolved, CASE WHEN a.v IS NOT NULL THEN 'small' || CASE WHEN a.n > 1 THEN '_ambiguous' ELSE '' END
    WHEN b.v IS NOT NULL THEN 'large' || CASE WHEN b.n > 1 THEN '_ambiguous' ELSE '' END ELSE 'unresolved' END AS route FROM part LEFT JOIN a ON a.k = p_brand LEFT JOIN b ON b.k = p_brand""")
def priority_resolution(spark, d):
    parts = _table(spark, d, "part")
    tiers = [(name, parts.where(which).select("p_brand", "p_partkey"), ["p_partkey"]) for name, which in (("small", "p_size < 5"), ("large", "p_size >= 20"))]
    return resolve.cascade(parts.select("p_partkey", "p_brand"), "p_brand", tiers).select("p_partkey", "resolved", "route")


# What a normalizer would say of parts: a compound for three of five, shared by parts of one brand and size of 40 and more,
# another ChEBI identifier for some, nothing at all for some.
_KNOWN = """(SELECT 'CHEBI:' || p_partkey AS curie, CASE WHEN p_partkey % 5 < 3 THEN 'PUBCHEM.COMPOUND:' || CASE WHEN p_size >= 40 THEN p_brand || p_size ELSE CAST(p_partkey AS VARCHAR) END END AS pubchem,
    CASE WHEN p_partkey % 7 = 0 THEN 'CHEBI:x' || p_partkey WHEN p_partkey % 5 = 4 THEN NULL ELSE 'CHEBI:' || p_partkey END AS chebi FROM part WHERE p_partkey % 11 <> 0)"""


@query(f"""WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN p_name || ' ' || p_partkey ELSE 'chebi:' || p_partkey END AS source, CASE WHEN p_partkey % 13 <> 0 THEN 'CHEBI:' || p_partkey END AS asked FROM part),
    f AS (SELECT source, asked, pubchem, chebi, CASE WHEN asked IS NULL THEN source WHEN curie IS NOT NULL AND p_partkey % 17 = 0 THEN source ELSE coalesce(pubchem, chebi, asked) END AS chosen,
      CASE WHEN asked IS NULL THEN 'NO-ID' WHEN curie IS NULL THEN 'UNRESOLVED' WHEN p_partkey % 17 = 0 THEN 'OVERRIDE' WHEN chebi <> asked THEN 'CHEBI-DRIFT' WHEN pubchem IS NOT NULL THEN 'OK' WHEN chebi IS NOT NULL THEN 'NO-CID' ELSE 'UNRESOLVED' END AS flag
      FROM s LEFT JOIN {_KNOWN} k ON k.curie = s.asked),
    g AS (SELECT chosen, string_agg(source, ' ' ORDER BY source) AS all_, count(*) AS n FROM f WHERE flag NOT IN ('UNRESOLVED', 'NO-ID') GROUP BY 1 HAVING count(*) > 1),
    r AS (SELECT source, f.chosen, CASE WHEN n IS NOT NULL THEN 'COLLISION' ELSE flag END AS flag, n FROM f LEFT JOIN g ON g.chosen = f.chosen AND flag NOT IN ('UNRESOLVED', 'NO-ID'))
    SELECT source, chosen, flag, CAST(coalesce(n - 1, 0) AS BIGINT) AS others, CASE flag WHEN 'COLLISION' THEN 1 WHEN 'CHEBI-DRIFT' THEN 2 WHEN 'OVERRIDE' THEN 3 WHEN 'NO-CID' THEN 4 WHEN 'OK' THEN 5 WHEN 'UNRESOLVED' THEN 6 ELSE 7 END AS severity FROM r""")
def clique_flags(spark, d):
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    parts = _table(spark, d, "part")
    nodes = parts.select(F.lit("p").alias("net"), F.when(k % 13 != 0, F.concat(F.lit("chebi:"), text)).alias("represents"), F.concat("p_name", F.lit(" "), text).alias("name"))
    pubchem = F.when(k % 5 < 3, F.concat(F.lit("PUBCHEM.COMPOUND:"), F.when(F.col("p_size") >= 40, F.concat("p_brand", F.col("p_size").cast("string"))).otherwise(text)))
    chebi = F.when(k % 7 == 0, F.concat(F.lit("CHEBI:x"), text)).when(k % 5 != 4, F.concat(F.lit("CHEBI:"), text))
    known = parts.where("p_partkey % 11 <> 0").select(F.concat(F.lit("CHEBI:"), text).alias("curie"), F.lit(None).cast("string").alias("label"), F.filter(F.array(chebi, pubchem), lambda x: x.isNotNull()).alias("clique"))
    # Kept identifiers are a table of people's decisions; here every seventeenth.
    keep = [f"chebi:{r[0]}" for r in parts.where("p_partkey % 17 = 0").select("p_partkey").collect()]
    found = C.review(C.profile(nodes), known, keep)
    return found.select("source", "chosen", "flag", F.coalesce(F.size("collides_with"), F.lit(0)).cast("bigint").alias("others"), C.severity(F.col("flag")).cast("int").alias("severity"))


@query("""SELECT coalesce(a.k, b.k) AS custkey, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side
    FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k""")
def coverage_check(spark, d):
    left = _table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("custkey"))
    return resolve.coverage(left, _table(spark, d, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def rejects_report(spark, d):
    return resolve.rejects(_table(spark, d, "customer"), _table(spark, d, "orders").where("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("SELECT event_type AS route, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM events), 4) AS share FROM events GROUP BY 1")
def route_histogram(spark, d):
    found = resolve.with_shares(_table(spark, d, "events").withColumnRenamed("event_type", "route"), ["route"])
    return found.select("route", "n", F.round("share", 4).alias("share"))


@query("SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 1000 AS BIGINT) AS batch FROM orders")
def batch_numbers(spark, d):
    return positions.batches(_table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 1000).select("o_orderkey", "batch")


@query("""WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS c FROM customer)
    SELECT c_custkey, round(5 + 100 * cos(2 * pi() * i / c), 6) AS ring_x, round(7 + 100 * sin(2 * pi() * i / c), 6) AS ring_y, CAST(30.0 * (i % CAST(floor(sqrt(c)) AS BIGINT)) AS DOUBLE) AS x, CAST(30.0 * (i // CAST(floor(sqrt(c)) AS BIGINT)) AS DOUBLE) AS y FROM n""")
def ring_and_grid_layout(spark, d):
    ring = positions.ring_layout(_table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 100.0, (5.0, 7.0))
    ring = ring.select("c_custkey", *[F.round(c, 6).alias(f"ring_{c}") for c in ("x", "y")])
    return positions.grid_layout(ring, ["c_custkey"], 30.0)


@query("""SELECT '<http://x.org/c/' || c_custkey || '> <http://www.w3.org/2000/01/rdf-schema#label> "' || c_name || '" .' AS value FROM customer
    UNION ALL SELECT '<http://x.org/c/' || c_custkey || '> <http://x.org/nation> "' || c_nationkey || '"^^<http://www.w3.org/2001/XMLSchema#integer> .' FROM customer""")
def ntriples_lines(spark, d):
    from graphspark.plans.convert import ntriples

    iri, rows = F.concat(F.lit("http://x.org/c/"), "c_custkey"), _table(spark, d, "customer")
    label = rows.select(iri.alias("s"), F.lit(I.STANDARD_PREFIXES["rdfs"] + "label").alias("p"), F.col("c_name").alias("o"), F.lit("string").alias("kind"))
    return ntriples(label.union(rows.select(iri, F.lit("http://x.org/nation"), F.col("c_nationkey").cast("string"), F.lit("integer"))))


@query(f"SELECT count(*) AS facts, count(DISTINCT subject) AS subjects, count(DISTINCT object) FILTER (object % 2 = 0) AS even_objects, count(*) FILTER (l_returnflag NOT LIKE 'R%') AS kept FROM {_F}")
def audit_counts(spark, d):
    return _facts(spark, d).agg(F.count("*").alias("facts"), F.count_distinct("subject").alias("subjects"), F.count_distinct(F.when(F.col("object") % 2 == 0, F.col("object"))).alias("even_objects"), F.count_if(~F.col("l_returnflag").startswith("R")).alias("kept"))


@query(f"SELECT object AS partner, subject, CAST(max(n) AS BIGINT) AS most, CAST(sum(n) AS BIGINT) AS total FROM {_F} WHERE l_returnflag = 'A' GROUP BY 1, 2")
def pair_evidence(spark, d):
    return _facts(spark, d).where("l_returnflag = 'A'").groupBy(F.col("object").alias("partner"), "subject").agg(F.max("n").alias("most"), F.sum("n").alias("total"))


@query("SELECT event_id, event_type FROM events WHERE lower(event_type) IN ('click', 'view')")
def type_set_filter(spark, d):
    return select.of_types(_table(spark, d, "events"), "event_type", ["Click", "VIEW"]).select("event_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('P', 'F')")
def flag_exclusion(spark, d):
    return select.without_flags(_table(spark, d, "orders"), "o_orderstatus", ["P", "F"]).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def resume_skip(spark, d):
    done = _table(spark, d, "lineitem").where("l_returnflag = 'R'")
    return resolve.rejects(_table(spark, d, "orders"), done, "o_orderkey", "l_orderkey").select("o_orderkey")


@query("SELECT p_brand, count(DISTINCT p_type) AS types, count(*) AS n, min(p_size) AS least, max(p_size) AS most, (min(p_size) + max(p_size)) / 2.0 AS centre FROM part GROUP BY 1")
def id_profile(spark, d):
    return _table(spark, d, "part").groupBy("p_brand").agg(F.count_distinct("p_type").alias("types"), F.count("*").alias("n"), F.min("p_size").alias("least"), F.max("p_size").alias("most"), ((F.min("p_size") + F.max("p_size")) / 2.0).cast("double").alias("centre"))


@query("SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_type) > 1 THEN p_type || '_' || p_partkey ELSE p_type END AS name FROM part")
def disambiguate_names(spark, d):
    parts = _table(spark, d, "part").select("p_partkey", "p_type")
    return resolve.disambiguated(parts, "p_type", F.col("p_partkey").cast("string"), "name").select("p_partkey", "name")


@query("SELECT n_nationkey AS key, 'left' AS side FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey < 20) UNION ALL SELECT DISTINCT c_nationkey, 'right' FROM customer WHERE c_nationkey >= 20 AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 22)")
def symbol_difference(spark, d):
    n, c = _table(spark, d, "nation").select(F.col("n_nationkey").alias("key")), _table(spark, d, "customer").select(F.col("c_nationkey").alias("key"))
    left = n.join(c.where("key < 20"), "key", "left_anti").withColumn("side", F.lit("left"))
    return left.union(c.where("key >= 20").join(n.where("key < 22"), "key", "left_anti").distinct().withColumn("side", F.lit("right")))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN 'Complex' WHEN 'view' THEN 'IncreaseAmount' END AS kind, CASE WHEN event_type IN ('click', 'view') THEN 'u' || user_id END AS subject,
    CASE WHEN event_type IN ('click', 'view') THEN 'e' || event_id END AS object FROM events""")
def verb_text_parse(spark, d):
    verb = F.when(F.col("event_type") == "click", " binds  ").when(F.col("event_type") == "view", " Increases the amount of ").when(F.col("event_type") == "purchase", " touches ").otherwise(" binds the ")
    rows = _table(spark, d, "events").select("event_id", E.text_relation(F.concat(F.lit("u"), "user_id", verb, F.lit("e"), "event_id")).alias("r"))
    return rows.select("event_id", "r.kind", "r.subject", "r.object")


#: Modules that register more queries.
_MORE = ("graph_queries", "merge_queries", "term_queries")


def queries() -> dict[str, registry.Query]:
    for name in _MORE:
        importlib.import_module(f"graphspark.plans.{name}")
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(registry.ORACLE)
