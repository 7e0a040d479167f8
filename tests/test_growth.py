"""What keeps the cost of conversion and merging in step with the input."""

import pytest
from pyspark.sql import functions as F

from graphspark.functions import evidence as E
from graphspark.operators import patterns
from graphspark.plans import convert as V
from graphspark.plans import graph_queries as Q
from graphspark.plans import merge as M
from graphspark.plans import star
from graphspark.sources.cx2 import Networks

SF = "/root/testdata/sf0.001"


def _link(s, o, kind="Activation", n=1):
    return f'<li/>x(<a href="https://x.org/e?subject={s}&object={o}&type={kind}">{n}</a>)'


def test_one_item_is_read_as_many_are(spark):
    texts = [_link("a", "b"), _link("a%20c", "b+d"), _link("", "b"), '<li/>A binds B(<a href="http://x.org/">7</a>)', '<li/>nothing(<a href="x?subject=a&object=b&type=c">1</a>)', "", None]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, h string")
    twice = rows.withColumn("h", F.concat("h", F.lit(_link("last", "one"))))
    got = [[(r.k, r.i, r.r) for r in E.exploded(df, "h", "k").orderBy("k", "i").collect()] for df in (rows, twice)]
    assert got[0] == [x for x in got[1] if x[2].subject != "last"] and [x[0] for x in got[0]] == [0, 1, 3]
    assert {r.k for r in E.exploded_outer(rows, "h", "k").collect()} == set(range(len(texts)))


def test_axioms_and_families_read_no_statements(spark):
    g = V.convert(star.networks(spark, SF), chemicals=star.chemicals(spark, SF))
    assert g.axioms.count() == 20 and g.triples_of_kind(V.HAS_MEMBER).count() == 50
    assert "_stated" not in vars(g) and "_linked" not in vars(g)
    assert g.triples_of_kind(V.PARTICIPATES).count() > 0 and "_stated" not in vars(g)


def test_nodes_are_dealt_out(spark):
    plan = V.resolved_nodes(star.networks(spark, SF), chemicals=star.chemicals(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [net" in plan and plan.index("aliases") < plan.index("RepartitionByExpression")


def test_a_plain_item_says_what_any_does(spark):
    link = lambda query, scheme="https://x.org/e", n=1: f'<li/>A binds B(<a href="{scheme}{query}" target="_blank">{n}</a>)'
    texts = [
        link("?type=t&object=o&subject=s"), link("?subject=1&subject=2&object=3&object=4&type=5&type="), link("?subject=&subject=2&object=3&type=4"), link("?subject=a%26b&subject=c&object=d&type=e"),
        link("?xsubject=0&subject=1&object=2&type=3#subject=9&type=8"), link("#?subject=1&object=2&type=3"), link("?a?subject=0&subject=1&object=2&type=3"), link("?subject=1&object=2&type=3", scheme="no-scheme"),
        link("?subject=\x01&object=2&type=3"), link("?subject=1&object=2&type=3") + "\n", "x" + link("?subject=1&object=2&type=3"), link("?" + "k=v&" * 60 + "subject=1&object=2&type=3"), link("?subject=1&object=2&type=3", n="007"), "\x01u\x01s\x01o\x01t\x011",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, h string")
    got = [(r.k, r.i, tuple(r.r)) for r in E.exploded(rows, "h", "k").orderBy("k", "i").collect()]
    want = [(r.k, r.i, tuple(r.r)) for r in rows.select("k", F.posexplode(E.relations(F.col("h"))).alias("i", "r")).orderBy("k", "i").collect()]
    assert got == want and len({k for k, _, _ in got}) == 13


def test_statements_read_no_memberships_and_texts_are_not_moved(spark, monkeypatch):
    plans, real = {}, V.store

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label)

    monkeypatch.setattr(V, "store", seen)
    g = V.convert(star.networks(spark, SF), chemicals=star.chemicals(spark, SF))
    assert g.bare_statements.count() > 0 and "_linked" not in vars(g)
    # Below the joins with nodes, each relation is read; above, nothing is.
    joins = plans["graph_stated"].index("ShuffledHashJoin")
    assert "regexp_replace" not in plans["graph_stated"][:joins] and "regexp_extract_all" not in plans["graph_stated"][:joins]


def test_rejects_read_no_relations_of_whole_edges(spark):
    nodes = spark.createDataFrame([("n", 1, {"name": "a", "represents": "a"}), ("n", 2, {"name": "b", "represents": "b"}), ("n", 3, {"name": "c"}), ("n", 2, {"name": "d", "represents": "d"})], "net string, id bigint, v map<string,string>")
    nodes = nodes.select("net", F.col("id").alias("ord"), "id", *[F.lit(None).cast("double").alias(c) for c in "xyz"], "v")
    two, one = _link("a", "b") + _link("b", "a"), _link("a", "c")
    edges = [(7, 1, 2, two), (7, 1, 9, one), (8, 2, 3, two), (9, 3, 1, "x"), (10, None, 1, None), (11, 1, 2, one), (11, 1, 2, one), (12, 9, 9, one), (12, 9, 9, two)]
    edges = spark.createDataFrame([("n", i, i, s, t, {} if h is None else {"Relationships": h}) for i, s, t, h in edges], "net string, ord bigint, id bigint, s bigint, t bigint, v map<string,string>")
    about = spark.createDataFrame([("n", None)], "net string, context map<string,string>")
    rows = lambda g: sorted(r.id for r in g.rejects.where("kind = 'edge'").collect())
    lean, full = (V.convert(Networks(about, nodes, edges)) for _ in range(2))
    full.bare_statements.count()
    assert "_stated" in vars(full) and rows(lean) == rows(full) == [7, 8, 8, 8, 8, 9, 10, 12, 12, 12] and "_stated" not in vars(lean)
    none = V.convert(Networks(about, nodes, edges.where("id = 11")))
    assert rows(none) == [] and "_stated" not in vars(none)


def test_one_pathway_needs_no_lists_of_pathways(spark):
    plan = Q.pathway_scope(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan and "collect_set" not in plan and plan.count("LeftSemi") == 2
    g = star.graph(spark, SF)
    pathway = g.memberships.first().o
    rows = lambda df: sorted(tuple(r) for r in df.select("net", "stmt").collect())
    assert rows(patterns.within(g.statements, pathway)) == rows(patterns.within_members(g.bare_statements, g.memberships, pathway)) != []


def test_volumes_are_counted_without_what_they_count(spark, monkeypatch):
    plans, real = {}, V.store

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString(), df.columns
        return real(df, label)

    monkeypatch.setattr(V, "store", seen)
    lean, full = (V.convert(star.networks(spark, SF), chemicals=star.chemicals(spark, SF)) for _ in range(2))
    counted = V.volumes(lean)
    joined = counted._jdf.queryExecution().executedPlan().toString()
    got = {r.family: r.n for r in counted.collect()}
    # Neither URLs of relations nor IRIs of pathways are carried, and no member is broadcast, however small its file is.
    assert "_stated" not in vars(lean) and not {"url", "n", "process"} & set(plans["graph_said"][1]) and "graph_paths" not in plans
    assert joined.count("ShuffledHashJoin") == 2 and "collect_set" not in joined
    want = full.statements.agg(F.count("*").alias("statements"), F.sum(F.size("in_pathways")).alias("links")).first()
    assert got == {"entities": full.entities.count(), "triples": full.triples.count(), "statements": want.statements, "pathway links": want.links, "rejects": full.rejects.count()} and want.links > 0
    # Relations that have been read are not read again.
    assert {r.family: r.n for r in V.volumes(full).collect()} == got and full._said is full._stated


def test_volumes_of_odd_networks(spark):
    node = lambda k, **v: ("n", k, {a: b for a, b in v.items() if b})
    nodes = [node(1, name="a", represents="a"), node(2, name="b", represents="b"), node(3, name="c"), node(4, name="a", represents="a"), node(5, name="p", type="pathway"), node(5, name="q", type="pathway"), node(6, name="q", type="pathway"), node(7, name="f", type="proteinfamily", member='["x:1","x:1"]')]
    nodes = spark.createDataFrame(nodes, "net string, id bigint, v map<string,string>")
    nodes = nodes.select("net", F.monotonically_increasing_id().alias("ord"), "id", *[F.lit(None).cast("double").alias(c) for c in "xyz"], "v")
    inside = [(k, s, t, {"interaction": V.MEMBERSHIP}) for k, (s, t) in enumerate([(1, 5), (5, 2), (4, 5), (2, 6), (6, 1), (9, 5), (3, 5), (1, 2)], 20)]
    said = [(1, 1, 2, _link("a", "b")), (2, 1, 2, _link("a", "b") + _link("b", "a") + _link("a", "a")), (3, 4, 2, _link("unknown", "b")), (4, 1, 9, _link("a", "b") * 2), (5, 2, 3, None), (6, 2, 5, _link("b", "q"))]
    edges = spark.createDataFrame([("n", i, i, s, t, h if isinstance(h, dict) else {"Relationships": h} if h else {}) for i, s, t, h in inside + said], "net string, ord bigint, id bigint, s bigint, t bigint, v map<string,string>")
    for edges in (edges, edges.where("false")):
        g, plain = (V.convert(Networks(spark.createDataFrame([("n", None)], "net string, context map<string,string>"), nodes, edges)) for _ in range(2))
        st = plain.statements.collect()
        want = {"entities": plain.entities.count(), "triples": plain.triples.count(), "statements": len(st), "pathway links": sum(len(r.in_pathways) for r in st), "rejects": plain.rejects.count()}
        assert {r.family: r.n for r in V.volumes(g).collect()} == want
        assert want["statements"] == 0 or want["pathway links"] >= 8


def test_prefixes_are_made_once(spark):
    plan = Q.canonical_context(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 1


def test_counts_of_edges_read_no_evidence(spark):
    plan = Q.edge_routing(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan and "x.org" not in plan


def test_names_of_nodes_are_read_once(spark, monkeypatch):
    plans, real = {}, M.store

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, label)

    monkeypatch.setattr(M, "store", seen)
    nodes = '[{"id":1,"v":{"r":"up:1","n":"a"}},{"id":2,"v":{"represents":"","n":"b"}},{"id":3,"v":{}},{"id":4}]'
    found = M.merge(spark.createDataFrame([("a.cx2", f'[{{"nodes":{nodes}}}]')], "net string, content string"))._known
    assert {r.id: r.key for r in found.collect()} == {1: "up:1", 2: "__file0__b", 3: "__file0__3", 4: "__file0__4"}
    projected = [line for line in plans["known"].splitlines() if "Project [" in line]
    assert sum(line.count("get_json_object") for line in projected) == 4
