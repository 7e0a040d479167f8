"""Graph patterns over triples (s, p, o), statements, labels, aliases and memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_predicate(triples: DataFrame, predicate: str) -> DataFrame:
    """(s, o) of all triples of a predicate."""
    return triples.where(F.col("p") == predicate).select("s", "o")


def statements_with(statements: DataFrame, predicate: str | None = None, process: str | None = None, above: int | None = None) -> DataFrame:
    """The statements of a predicate, of a process, of more evidence than ``above``, or of all that are given."""
    if predicate is not None:
        statements = statements.where(F.col("p") == predicate)
    if process is not None:
        statements = statements.where(F.col("process_type") == process)
    return statements if above is None else statements.where(F.col("evidence_count") > above)


def modifications(statements: DataFrame) -> DataFrame:
    """The statements that carry a process, with it."""
    return statements.where(F.col("process_type").isNotNull())


def levels(triples: DataFrame, statements: DataFrame) -> DataFrame:
    """s, p, o, statements and evidence: each direct triple with how many statements and how much evidence stand behind it; 0
    for those that none states."""
    behind = statements.groupBy("s", "p", "o").agg(F.count("*").alias("statements"), F.sum("evidence_count").alias("evidence"))
    return triples.select("s", "p", "o").distinct().join(behind, ["s", "p", "o"], "left").fillna(0, ["statements", "evidence"])


def members_of(triples: DataFrame, group: str, predicate: str) -> DataFrame:
    """(entity): what participates in ``group``."""
    return triples.where((F.col("p") == predicate) & (F.col("o") == group)).select(F.col("s").alias("entity")).distinct()


def within(statements: DataFrame, group: str) -> DataFrame:
    """The statements that are in a pathway."""
    return statements.where(F.array_contains("in_pathways", group))


def within_members(statements: DataFrame, memberships: DataFrame, group: str) -> DataFrame:
    """``within`` for statements that do not list their pathways: those whose two ends are members of ``group`` in their
    network. Only the members of this group are met with."""
    members = memberships.where(F.col("o") == group).select(F.col("net").alias("_net"), F.col("s").alias("_member"))
    for side in ("s", "o"):
        statements = statements.join(members, (F.col("net") == F.col("_net")) & (F.col(side) == F.col("_member")), "left_semi")
    return statements


def families_of(triples: DataFrame, entities: DataFrame, class_: str, predicate: str) -> DataFrame:
    """(family, label, member): the members of entities of a class; two patterns that meet in the family."""
    families = entities.where(F.col("class") == class_).select(F.col("iri").alias("family"), "label")
    return families.join(triples.where(F.col("p") == predicate).select(F.col("s").alias("family"), F.col("o").alias("member")), "family").distinct()


def partners(triples: DataFrame, entities: DataFrame, predicate: str) -> DataFrame:
    """(s, s_label, o, o_label) of a predicate's triples whose ends both have a label."""
    label = entities.where(F.col("label").isNotNull()).select("iri", "label")
    found = with_predicate(triples, predicate)
    for side in ("s", "o"):
        found = found.join(label.select(F.col("iri").alias(side), F.col("label").alias(f"{side}_label")), side)
    return found.select("s", "s_label", "o", "o_label").distinct()


def pure_core(scored: DataFrame, role: str = "role") -> DataFrame:
    """The scored statements that are not there for connectivity only; a null role is none."""
    return scored.where(~F.coalesce(F.col(role) == "backbone", F.lit(False)))


def symmetric(facts: DataFrame, s: str, o: str) -> DataFrame:
    """Pairs in both directions, once each."""
    return facts.select(F.col(s).alias("a"), F.col(o).alias("b")).union(facts.select(o, s)).distinct()


def participants(facts: DataFrame, s: str, o: str) -> DataFrame:
    return facts.select(F.col(s).alias("entity")).union(facts.select(o)).distinct()


def shared_groups(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b, group): the groups that hold both ends of ``pairs`` (a, b); members are (member, group).

    Both joins are on one key, and the second on two, so a large group is never squared.
    """
    first = pairs.join(members.select(F.col("member").alias("a"), "group"), "a")
    return first.join(members.select(F.col("member").alias("b"), "group"), ["b", "group"]).select("a", "b", "group").distinct()


def expanded_by_alias(facts: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """``facts`` once more under each alias of ``column``; aliases are (name, alias)."""
    other = facts.join(aliases, F.col(column) == F.col("name")).withColumn(column, F.col("alias")).select(*facts.columns)
    return facts.union(other).distinct()


def if_any(rows: DataFrame, of: DataFrame) -> DataFrame:
    """``rows`` if ``of`` has any row, else none; the check is one row."""
    some = of.limit(1).agg((F.count("*") > 0).alias("_some"))
    return rows.join(F.broadcast(some)).where("_some").drop("_some")
