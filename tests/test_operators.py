"""Operators on small literal tables: hierarchies, positions, tables and their files, terms, symbols, reviews."""

import json

import pytest
from pyspark.sql import functions as F

from graphspark.functions import chemicals as C
from graphspark.operators import dedup, hierarchy, positions, select, symbols
from graphspark.plans import systems as S
from graphspark.sinks import tables as out
from graphspark.sources import cx2
from graphspark.sources import tables as src


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_closure_of_any_depth(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)], "parent long, child long")
    assert hierarchy.closure(chain).count() == 200 * 201 // 2
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("r", "a"), (None, "a"), ("r", None)], "parent string, child string")
    pairs = {tuple(r) for r in hierarchy.closure(ring).collect()}
    assert len(pairs) == 12 and ("a", "a") in pairs and ("r", "c") in pairs
    assert rows(hierarchy.roots(ring), "node") == [("r",)]
    assert hierarchy.closure(chain.limit(0)).count() == 0


def test_only_root(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "node long")
    assert rows(hierarchy.only_root(nodes, spark.createDataFrame([(1, 2), (2, 3)], "parent long, child long")), "node") == [(1,)]
    for edges in ([(1, 2)], [(1, 2), (2, 3), (3, 1)]):
        with pytest.raises(Exception, match="exactly one root"):
            hierarchy.only_root(nodes, spark.createDataFrame(edges, "parent long, child long")).collect()


def test_positions(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "k string, o long")
    assert rows(positions.dense_ids(df, "k", "o", 3).where("k IS NOT NULL"), "k", "id") == [("a", 1), ("b", 0), ("c", 2)]
    assert positions.dense_positions(df.limit(0), ["o"]).count() == 0
    assert rows(positions.grid_layout(df, ["o"], 10.0), "o", "x", "y") == [(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 0.0, 10.0), (4, 10.0, 10.0), (5, 0.0, 20.0)]


def test_best_edges(spark):
    edges = spark.createDataFrame([(1, "a", "b", 0.5), (2, "b", "a", 0.5), (3, "a", None, 0.9), (4, "c", "a", None), (5, "c", "d", 0.1)], "i long, a string, b string, score double")
    assert rows(select.core_backbone(edges, ["a", "b"], "score", ["i"], 0.8), "i", "role") == [(1, "backbone"), (2, "backbone"), (3, "core"), (5, "backbone")]
    with pytest.raises(ValueError):
        select.with_payload(edges, "i", 0)


def test_first_lists(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (1, 3, "y"), (2, 1, "z")], "k int, o int, item string")
    assert rows(dedup.first_list(df, ["k"], "item", ["o"], "l"), "k", "l") == [(1, ["y", "x"]), (2, ["z"])]


def test_table_files(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("code\tname\tterms\toverride\treason\n# note\n\nA\tx\tp|q\n  B \ty\tr\tT:1\tbecause\n")
    columns = ["code", "name", "terms", "override", "reason"]
    got = src.read_commented(spark, f"file://{tmp_path}/t.tsv", columns, 3, {"override": "reason"})
    assert rows(got, *columns) == [("A", "x", "p|q", "", ""), ("B", "y", "r", "T:1", "because")]
    (tmp_path / "bad.tsv").write_text("A\tx\tp\tT:1\n")
    with pytest.raises(Exception, match="override without reason"):
        src.read_commented(spark, f"file://{tmp_path}/bad.tsv", columns, 3, {"override": "reason"}).collect()
    (tmp_path / "short.tsv").write_text("A\tx\n")
    with pytest.raises(Exception, match="3 fields"):
        src.read_commented(spark, f"file://{tmp_path}/short.tsv", columns, 3).collect()
    (tmp_path / "ids.csv").write_text('"network_id"\r\nu1\n\n"u2"\nu1\n')
    assert rows(src.read_ids(spark, f"file://{tmp_path}/ids.csv"), "id") == [("u1",), ("u2",)]
    (tmp_path / "s.json").write_text(json.dumps({"a": {"uri_format": "https://a/$1"}, "b": {"uri_format": "https://b/$1/x"}, "c": {}}))
    assert rows(src.registry_stems(src.read_snapshot(spark, f"file://{tmp_path}/s.json", "struct<uri_format:string>")), "prefix", "stem") == [("a", "https://a/")]
    out.write_tsv(spark.createDataFrame([("k", [1, 2], None)], "a string, b array<int>, c string"), f"file://{tmp_path}/o", 1)
    back = src.read_tsv(spark, f"file://{tmp_path}/o")
    assert back.columns == ["a", "b", "c"] and rows(back, "a", "b") == [("k", "1|2")]
    twice = spark.createDataFrame([("a", "1"), ("b", ""), ("a", "2")], "k string, v string").coalesce(1)
    assert rows(src.dimension(twice, "k", "v"), "k", "v") == [("a", "2")]
    cache = spark.createDataFrame([("a", 1)], "key string, value int")
    assert rows(src.looked_up(twice, cache, "k", "x", offline=False), "k", "x") == [("a", 1), ("a", 1), ("b", None)]
    with pytest.raises(Exception, match="not cached"):
        src.looked_up(twice, cache, "k", "x").collect()


def test_manifest(spark, tmp_path):
    path = f"file://{tmp_path}/m"
    assert out.read_manifest(spark, path).count() == 0
    nets = spark.createDataFrame([("11111111-a", "One/Two"), ("22222222-b", "One/Two"), ("33333333-c", " "), ("44444444-d", "..used")], "id string, name string")
    named = out.with_files(nets, spark.createDataFrame([("used.cx2",)], "file string"))
    assert rows(named, "id", "file") == [("11111111-a", "One_Two.cx2"), ("22222222-b", "One_Two_22222222.cx2"), ("33333333-c", "33333333-c.cx2"), ("44444444-d", "used_44444444.cx2")]
    out.write_manifest(named, path)
    assert rows(out.pending(nets, out.read_manifest(spark, path), named.where("id < '3'").select("file")), "id") == [("33333333-c",), ("44444444-d",)]


def test_cached_networks(spark, tmp_path):
    (tmp_path / "u1.cx2").write_text(json.dumps([{"networkAttributes": [{"name": "h", "link": "u2", "schema": "other"}]}]))
    found = cx2.cached(spark, f"file://{tmp_path}", ["u1"])
    assert cx2.linked_network(cx2.fragments(found), "u1", "link", "schema", "h1") == ("u2", "schema is 'other', expected 'h1'")
    with pytest.raises(ValueError, match="no network attribute"):
        cx2.linked_network(cx2.fragments(found), "u1", "nothing")
    with pytest.raises(FileNotFoundError, match="u9"):
        cx2.cached(spark, f"file://{tmp_path}", ["u1", "u9"])


def test_review(spark, tmp_path):
    nodes = spark.createDataFrame([("n1", "chebi:1", "one"), ("n2", "chebi:1", "eins"), ("n1", "CHEBI:2", "two"), ("n1", "CHEBI:3", "3|x"), ("n1", None, "bare"), ("n1", "CHEBI:16066", "kept"), ("n1", "CHEBI:9", "nine"), ("n1", None, None)], "net string, represents string, name string")
    known = [("CHEBI:1", "L1", ["PUBCHEM.COMPOUND:7", "CHEBI:1"]), ("CHEBI:2", "L2", ["CHEBI:2", "PUBCHEM.COMPOUND:7"]), ("CHEBI:3", None, ["CHEBI:30"]), ("CHEBI:16066", None, ["PUBCHEM.COMPOUND:8", "CHEBI:5"])]
    found = C.review(C.profile(nodes), spark.createDataFrame(known, "curie string, label string, clique array<string>"))
    assert rows(found, "source", "flag", "chosen") == [("CHEBI:16066", "OVERRIDE", "CHEBI:16066"), ("CHEBI:2", "COLLISION", "PUBCHEM.COMPOUND:7"), ("CHEBI:3", "CHEBI-DRIFT", "CHEBI:30"), ("CHEBI:9", "UNRESOLVED", "CHEBI:9"), ("bare", "NO-ID", "bare"), ("chebi:1", "COLLISION", "PUBCHEM.COMPOUND:7")]
    assert [r.source for r in C.in_review_order(found).collect()] == ["chebi:1", "CHEBI:2", "CHEBI:3", "CHEBI:16066", "CHEBI:9", "bare"]
    assert {r.source: r.exact for r in C.snapshot(found, None).collect()}["CHEBI:16066"] == []
    out.write_lines(C.markdown(found, "Review"), f"file://{tmp_path}/md")
    text = [r.value for r in spark.read.text(f"file://{tmp_path}/md").collect()]
    assert text[0] == "# Review" and sum(x.startswith("| `") for x in text) == 5 + 6 and any("3\\|x" in x for x in text)


def test_symbols(spark):
    table = spark.createDataFrame([("AA", "HGNC:1", "Approved", "P1|P2", "OLD1", "AL"), ("BB", "HGNC:2", "Approved", "", "OLD1", "AL"), ("CC", "HGNC:3", "Approved", "P3", "", "AL"), ("DD", "HGNC:4", "Gone", "P4", "", "")], "symbol string, hgnc_id string, status string, uniprot_ids string, prev_symbol string, alias_symbol string").coalesce(1)
    ref = symbols.reference(table, spark.createDataFrame([("W", "HGNC:9")], "symbol string, gene string"))
    asked = spark.createDataFrame([(x,) for x in ("AA", "BB", "OLD1", "AL", "DD", "W", "Z")], "symbol string")
    cache = spark.createDataFrame([("DD", ["Q9"], "landed"), ("Z", [], "none")], "symbol string, accessions array<string>, route string")
    got = {r.symbol: (r.curie, r.route) for r in symbols.resolve(asked, ref, cache).collect()}
    assert got == {"AA": ("uniprot:P1", "approved_symbol"), "BB": ("hgnc:2", "hgnc_id_fallback"), "OLD1": ("uniprot:P1", "prev_symbol"), "AL": ("uniprot:P1", "alias_symbol_ambiguous"), "DD": ("uniprot:Q9", "landed"), "W": ("hgnc:9", "hgnc_id_fallback"), "Z": ("hgnc.symbol:Z", "hgnc_symbol_fallback")}


def test_one_system(spark):
    fields = S.Fields("ID")
    v = {"ID": "SYS:84", "Annotation": "one", "Size": "5", "Weight": "0.65", "adjusted  p-value": "1.0", fields.cohorts: " B A  C", "Mutation frequency:A": "0.25", fields.members: "[1,2,9]"}
    small, root = v | {"ID": "SYS:85", "Weight": "0", "adjusted  p-value": "0.01", fields.cohorts: ""}, {"ID": "SYS:17", "Annotation": "all", "Size": "400"}
    nodes = spark.createDataFrame([(1, v), (2, small), (3, root)], "id long, v map<string,string>")
    found = S.systems(nodes, fields)
    terms = spark.createDataFrame([("A", "t:a", "a"), ("B", "t:b", "b")], "code string, term string, label string")
    cohorts = S.cohort_rows(found, terms)
    assert rows(cohorts, "code", "term", "frequency") == [("A", "t:a", 0.25), ("B", "t:b", None), ("C", None, None)]
    assert S.cohort_facts(cohorts).count() == 8 + 7 and S.selection_facts(found).count() == 7
    assert {r.p.rpartition("/")[2].rpartition("#")[2] for r in S.system_facts(found).where("s LIKE '%SYS-85'").collect()} == {"type", "label", "identifier", "memberCount", "selectionPValue"}
    ids = spark.createDataFrame([(1, "u:1"), (2, "u:2")], "node long, iri string")
    assert S.member_facts(found, ids).count() == 4
    edges = spark.createDataFrame([(3, 1), (3, 2)], "s long, t long")
    assert S.containment_facts(edges, found).count() == 2
    table = spark.createDataFrame([("g1", 20), ("g2", 10)], "symbol string, node long")
    genes = nodes.withColumn("v", F.when(F.col("id") == 1, F.map_concat("v", F.create_map(F.lit("Genes"), F.lit("g1 g3 g2")))).otherwise(F.col("v")))
    one = {r.id: (r.is_root, r.members, r.member_names, r.genes) for r in S.with_members(genes, edges, table, fields).collect()}
    assert one == {1: (False, [10, 20], ["g2", "g1"], 3), 2: (False, [], [], 0), 3: (True, [], [], 0)}


def test_adapters(spark):
    known = S.Adapters()
    known.register(S.Adapter("plain", lambda nets: nets.nodes))
    with pytest.raises(ValueError):
        known.register(S.Adapter("plain", lambda nets: nets.edges))
    assert known.run("plain", cx2.parse(spark.createDataFrame([], "net string, content string"))).count() == 0
