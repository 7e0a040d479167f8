"""Queries over the merge of network files that are made of the star schema, one file a nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from graphspark.operators import resolve
from graphspark.plans import merge as M
from graphspark.plans import star
from graphspark.plans.registry import query
from graphspark.sources import cx2

# A file for each nation that has customers, in the order of its name; its index; what a customer is merged by.
_FILES = "(SELECT c_nationkey, 'n' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '.cx2' AS net, row_number() OVER (ORDER BY c_nationkey) - 1 AS file FROM (SELECT DISTINCT c_nationkey FROM customer))"
_NODES = f"(SELECT c.*, file, net, CASE WHEN c_custkey % 3 = 0 THEN '__file' || file || '__seg ' || c_mktsegment ELSE 'seg:' || c_mktsegment END AS key FROM customer c JOIN {_FILES} f ON f.c_nationkey = c.c_nationkey)"
_IDS = f"(SELECT key, CAST(row_number() OVER (ORDER BY pl) - 1 AS BIGINT) AS id FROM (SELECT key, min(file * 1000000000 + c_custkey) AS pl FROM {_NODES} GROUP BY 1))"
_EDGES = f"""(SELECT DISTINCT ON (s, t, o_orderstatus) s, t, o_orderstatus FROM (SELECT a.id AS s, b.id AS t, o_orderstatus FROM orders JOIN {_NODES} n ON o_custkey = n.c_custkey JOIN {_IDS} a ON a.key = n.key
    JOIN (SELECT file, arg_min(key, c_custkey) AS first FROM {_NODES} GROUP BY 1) f ON f.file = n.file JOIN {_IDS} b ON b.key = f.first))"""


@query(f"SELECT n.file, c_custkey, id FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key")
def remap_ids(spark, d):
    # The merged ids of every file's own ids: the key of a node, looked up among the merged nodes.
    merged = star.merged(spark, d)
    found = cx2.parse(star.files(spark, d)).nodes.join(merged.files, "net")
    key = M.I.node_key(F.col("v"), F.col("id"), F.col("file"))
    return found.select("file", F.col("id").alias("c_custkey"), key.alias("key")).join(merged.nodes.select("key", "id"), "key").select("file", "c_custkey", "id")


@query(f"SELECT id, arg_min(c_name, file * 1000000000 + c_custkey) AS n, min(CASE WHEN c_custkey % 5 = 0 THEN file * 1000000000 + c_custkey END) IS NOT NULL AS has_five, arg_min(c_custkey, file * 1000000000 + c_custkey) FILTER (c_custkey % 5 = 0) AS five FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key GROUP BY 1")
def attr_first_value(spark, d):
    v = F.col("v")
    text = lambda k: F.get_json_object(F.concat(F.lit('{"x":'), F.try_element_at(v, F.lit(k)), F.lit("}")), "$.x")
    return star.merged(spark, d).nodes.select("id", text("n").alias("n"), F.map_contains_key(v, "five").alias("has_five"), text("five").cast("bigint").alias("five"))


@query(f"""WITH a AS (SELECT id, c_mktsegment || c_custkey % 2 AS x, min(file * 1000000000 + c_custkey) AS pl, count(*) AS k FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key GROUP BY 1, 2)
    SELECT id, '[' || string_agg('"' || x || '"', ',' ORDER BY pl) || ']' AS aliases FROM a GROUP BY 1""")
def list_union(spark, d):
    return star.merged(spark, d).nodes.select("id", F.try_element_at("v", F.lit("alias")).alias("aliases"))


@query(f"SELECT DISTINCT id, file FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key")
def file_membership(spark, d):
    return star.merged(spark, d).membership


@query(f"SELECT CAST(file AS BIGINT) AS file, net FROM {_FILES}")
def sorted_files(spark, d):
    return star.merged(spark, d).files.select(F.col("file").cast("bigint").alias("file"), "net")


@query(f"SELECT s, t, '\"' || o_orderstatus || '\"' AS i FROM {_EDGES}")
def merged_edges(spark, d):
    return star.merged(spark, d, collapse=False).edges.select("s", "t", F.try_element_at("v", F.lit("i")).alias("i"))


@query(f"SELECT least(s, t) AS low, greatest(s, t) AS high, count(*) AS n FROM {_EDGES} GROUP BY 1, 2")
def pairs_before_collapse(spark, d):
    edges = star.merged(spark, d, collapse=False).edges
    return edges.groupBy(F.least("s", "t").alias("low"), F.greatest("s", "t").alias("high")).agg(F.count("*").alias("n"))


@query(f"""WITH n AS (SELECT count(*) AS n FROM {_IDS}) SELECT CAST(n + file AS BIGINT) AS id, 'pathway:n' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS stands, CASE WHEN c_nationkey % 2 = 0 THEN 'network:u' || c_nationkey WHEN c_nationkey % 3 = 0 THEN 'network:v' || c_nationkey END AS uuid,
    (SELECT count(DISTINCT id) FROM {_NODES} x JOIN {_IDS} i ON i.key = x.key WHERE x.file = f.file) AS members FROM {_FILES} f, n""")
def two_key_lookup(spark, d):
    nation = star.table(spark, d, "nation")
    k = F.col("n_nationkey").cast("string")
    stem = F.concat(F.lit("n"), F.lpad(k, 2, "0"))
    uuids = nation.where("n_nationkey % 2 = 0").select(F.concat(stem, F.lit(".cx2")).alias("name"), F.concat(F.lit("u"), k).alias("uuid")).union(nation.where("n_nationkey % 3 = 0").select(stem, F.concat(F.lit("v"), k)))
    merged = M.merge(star.files(spark, d), pathway_nodes=True, uuids=uuids)
    text = lambda name: F.get_json_object(F.concat(F.lit('{"x":'), F.try_element_at("v", F.lit(name)), F.lit("}")), "$.x")
    paths = merged.nodes.where(F.col("key").startswith("__pathway__")).select("id", text("r").alias("stands"), text("network_id").alias("uuid"))
    links = merged.edges.where(F.try_element_at("v", F.lit("i")) == '"participates in"').groupBy(F.col("s").alias("id")).agg(F.count("*").alias("members"))
    return paths.join(links, "id")


@query(f"""WITH p AS (SELECT id, min(CASE WHEN c_custkey % 2 = 0 THEN file * 1000000000 + c_custkey END) AS pl, arg_min(c_custkey, file * 1000000000 + c_custkey) FILTER (c_custkey % 2 = 0) AS x FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key GROUP BY 1),
    b AS (SELECT coalesce(min(x), 0.0) AS lo, coalesce(max(x), 0.0) AS hi FROM p WHERE pl IS NOT NULL), m AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k, greatest(1, CAST(floor(sqrt(count(*) OVER ())) AS BIGINT)) AS c FROM p WHERE pl IS NULL)
    SELECT id AS node, CAST(x AS DOUBLE) AS x, CAST(x AS DOUBLE) AS y FROM p WHERE pl IS NOT NULL UNION ALL SELECT id, lo + k % c * 30.0, hi + 50.0 + k // c * 30.0 FROM m, b""")
def coordinate_fallback(spark, d):
    return star.merged(spark, d).places.select("node", "x", "y")


@query(f"""WITH p AS (SELECT arg_min(c_custkey, file * 1000000000 + c_custkey) FILTER (c_custkey % 2 = 0) AS x FROM {_NODES} n JOIN {_IDS} i ON i.key = n.key GROUP BY i.id)
    SELECT CAST(min(x) AS DOUBLE) AS min_x, CAST(max(x) AS DOUBLE) AS max_x, (min(x) + max(x)) / 2.0 AS centre_x, CAST(greatest(max(x) - min(x), 1) AS DOUBLE) AS span FROM p""")
def layout_extent(spark, d):
    from graphspark.sources.cx2 import concatenated, fragments

    files = star.files(spark, d)
    numbered = M.indexed_files(files)
    elements = concatenated(fragments(numbered), ("nodes", "cartesianLayout")).join(numbered.select("net", "file"), "net")
    nodes = elements.where("aspect = 'nodes'").select("file", "ord", F.from_json("element", "struct<id:bigint,x:double,y:double,z:double,v:map<string,string>>").alias("n")).select("file", "ord", "n.*")
    known = nodes.withColumn("unified", F.xxhash64(M.I.node_key(F.col("v"), F.col("id"), F.col("file"))))
    return M.extent(M._places(known, elements)).select("min_x", "max_x", "centre_x", "span")


@query("""SELECT 'nodes' AS kind, name, spec FROM (VALUES ('name', '{"a":"n"}'), ('represents', '{"a":"r"}'), ('alias', '{"d":"list_of_string"}'), ('five', '{"d":"string"}')) t(name, spec) UNION ALL SELECT 'edges', 'i', '{"d":"string"}'""")
def spec_first_value(spark, d):
    return star.merged(spark, d).declared.select("kind", "name", "spec")


@query(f"SELECT net, '2' AS aspects, count(*) AS n_nodes, (SELECT count(*) FROM orders JOIN {_NODES} x ON o_custkey = x.c_custkey WHERE x.net = n.net) AS n_edges FROM {_NODES} n GROUP BY 1")
def network_metadata(spark, d):
    found = cx2.metadata(cx2.parse(star.files(spark, d)))
    return found.select("net", F.lit("2").alias("aspects"), "n_nodes", "n_edges")


@query("SELECT n_nationkey, n_name || '_' || n_nationkey AS name, n_name || '_' || n_nationkey || '.cx2' AS file FROM nation WHERE n_nationkey % 4 <> 0")
def pending_downloads(spark, d):
    from graphspark.sinks.tables import pending, with_files

    nation = star.table(spark, d, "nation").withColumn("id", F.col("n_nationkey").cast("string"))
    files = with_files(nation.select("id", F.concat("n_name", F.lit("/"), "id").alias("name"))).select("id", "file")
    done = files.where(F.col("id") % 2 == 0)
    # Of what the manifest names only every other file is there.
    left = pending(files, done, files.where(F.col("id") % 4 == 0))
    return left.join(nation.select("id", "n_nationkey", "n_name"), "id").select("n_nationkey", F.concat("n_name", F.lit("_"), "id").alias("name"), "file")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'even' WHEN n_nationkey < 12 THEN 'low' ELSE 'none' END AS found FROM nation")
def fallback_lookup(spark, d):
    n = star.table(spark, d, "nation").select("n_nationkey", F.col("n_nationkey").alias("a"), (F.col("n_nationkey") + 100).alias("b"))
    even = n.where("a % 2 = 0").select(F.col("a").alias("key"), F.lit("even").alias("value")).union(n.where("a < 12").select("b", F.lit("low")))
    return resolve.two_key_lookup(n, even, ["a", "b"], "found").select("n_nationkey", F.coalesce("found", F.lit("none")).alias("found"))
