"""Turtle and N-Triples files of triples (s, p, o, kind)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphspark.functions import identifiers as I
from graphspark.plans.convert import Graph, ntriples, prefix_rows, triples_of

#: Local parts that may stand behind a prefix.
_LOCAL = "^[A-Za-z0-9_][A-Za-z0-9_-]*$"


def prefix_lines(prefixes: list[tuple[str, str]], by_name: bool = False) -> list[str]:
    """The declarations of ``prefixes``, in their order or sorted by name."""
    return [f"@prefix {k}: <{v}> ." for k, v in (sorted(prefixes) if by_name else prefixes)]


def term(iri: Column, prefixes: list[tuple[str, str]]) -> Column:
    """An IRI under the first prefix that begins it, if the rest may stand behind a prefix; else in angle brackets. A blank
    node stays as it is."""
    out = F.concat(F.lit("<"), I.safe_iri(iri), F.lit(">"))
    for name, stem in reversed(prefixes):
        local = F.substr(iri, F.lit(len(stem) + 1))
        out = F.when(iri.startswith(stem), F.when(local.rlike(_LOCAL), F.concat(F.lit(f"{name}:"), local)).otherwise(F.concat(F.lit("<"), I.safe_iri(iri), F.lit(">")))).otherwise(out)
    return F.when(iri.startswith("_:"), iri).otherwise(out)


def _object(prefixes: list[tuple[str, str]]) -> Column:
    text = F.concat(F.lit('"'), I.escape_literal(F.col("o")), F.lit('"'))
    return F.when(F.col("kind") == "iri", term(F.col("o"), prefixes)).when(F.col("kind") == "string", text).when(F.col("kind") == "term", F.col("o")).otherwise(F.concat(F.lit('"'), F.col("o"), F.lit('"^^xsd:'), F.col("kind")))


def grouped_lines(triples: DataFrame, prefixes: list[tuple[str, str]], files: int) -> DataFrame:
    """value: the lines of ``files`` Turtle documents, each with the prefixes, with triples of one subject in one block.

    A subject's triples are numbered by a window over it alone, which spills; none is gathered into one row. Repeated triples
    are written once. ``kind`` is iri, string, term (a Turtle term as it is) or the name of an XML Schema type.
    """
    rows = triples.select("s", "p", "o", "kind").distinct()
    order = W.partitionBy("s").orderBy("p", "kind", "o")
    rdf_type = I.STANDARD_PREFIXES["rdf"] + "type"
    predicate = F.when(F.col("p") == rdf_type, "a").otherwise(term(F.col("p"), prefixes))
    numbered = rows.withColumns({"_k": F.row_number().over(order), "_last": F.lead("p").over(order).isNull()})
    body = F.concat(F.when(F.col("_k") == 1, F.concat(term(F.col("s"), prefixes), F.lit(" "))).otherwise("    "), predicate, F.lit(" "), _object(prefixes), F.when(F.col("_last"), " .").otherwise(" ;"))
    dealt = numbered.repartitionByRange(files, "s").sortWithinPartitions("s", "_k").select(body.alias("value"))
    heads = "\n".join(prefix_lines(prefixes)) + "\n"
    # The first row of each task carries the prefixes; a file is a task.
    first = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))) == 0
    return dealt.select(F.when(first, F.concat(F.lit(heads + "\n"), "value")).otherwise(F.col("value")).alias("value"))


def write_turtle(triples: DataFrame, path: str, prefixes: list[tuple[str, str]], files: int = 1) -> int:
    """Write Turtle documents to the folder ``path``; how many triples they hold. An empty table gives a folder without any."""
    grouped_lines(triples, prefixes, files).write.mode("overwrite").text(path)
    return triples.select("s", "p", "o", "kind").distinct().count()


def write_ntriples(triples: DataFrame, path: str) -> None:
    """Write N-Triples files to the folder ``path``, as many as there are tasks; no order and no shuffle."""
    ntriples(triples).write.mode("overwrite").text(path)


def write_graph(graph: Graph, path: str, files: int = 1) -> int:
    """Write a converted graph as Turtle, with the prefixes that its nodes call for; how many triples it holds."""
    pathways = not graph.axioms.isEmpty()
    families = not graph.triples.where(F.col("s").startswith(f"{graph.places.base}family/")).isEmpty()
    return write_turtle(triples_of(graph), path, prefix_rows(graph.places, pathways, families), files)
