"""Network files: JSON arrays of aspects with declared attributes, read into one DataFrame a kind of record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BAG = "map<string,string>"
_SPEC = "struct<d:string,a:string,v:string>"
_DECLARED = f"map<string,{_SPEC}>"
NODES = "array<struct<id:bigint,x:double,y:double,z:double,v:map<string,string>>>"
EDGES = "array<struct<id:bigint,s:bigint,t:bigint,v:map<string,string>>>"
KINDS = ("nodes", "edges", "networkAttributes")


@dataclass
class Networks:
    """networks (net, version, name, context, attributes, declared_nodes, declared_edges), nodes (net, ord, id, x, y, z, v),
    edges (net, ord, id, s, t, v)."""

    networks: DataFrame
    nodes: DataFrame
    edges: DataFrame


def fragments(files: DataFrame) -> DataFrame:
    """(net, pos, n_keys, aspect, payload): every key of every object of each file (net, content), its value as JSON text.

    What is no object is left out, as are files that are no JSON array; ``pos`` is the object's place in the array.
    """
    listed = files.select("net", F.posexplode(F.from_json("content", "array<string>")).alias("pos", "_e")).where(F.col("_e").startswith("{"))
    bags = listed.select("net", "pos", F.from_json("_e", _BAG).alias("_m"))
    return bags.select("net", "pos", F.size("_m").alias("n_keys"), F.explode("_m").alias("aspect", "payload"))


def last_arrays(found: DataFrame) -> DataFrame:
    """(net, aspect, payload): of each aspect the last value that is an array."""
    return found.where(F.col("payload").startswith("[")).groupBy("net", "aspect").agg(F.max_by("payload", "pos").alias("payload"))


def single_keyed(found: DataFrame) -> DataFrame:
    """(net, aspect, payload): of each aspect the last value, of objects with this one key."""
    return found.where("n_keys = 1").groupBy("net", "aspect").agg(F.max_by("payload", "pos").alias("payload"))


def concatenated(found: DataFrame, aspects: tuple[str, ...]) -> DataFrame:
    """(net, aspect, ord, element): the elements of the arrays of ``aspects`` one after another, as JSON text.

    A value that is no array puts an end to what was gathered before it; arrays after it begin anew.
    """
    own = found.where(F.col("aspect").isin(*aspects))
    broken = own.groupBy("net", "aspect").agg(F.max(F.when(~F.coalesce(F.col("payload").startswith("["), F.lit(False)), F.col("pos"))).alias("_end"))
    arrays = own.join(broken, ["net", "aspect"]).where(F.col("_end").isNull() | (F.col("pos") > F.col("_end")))
    each = arrays.select("net", "aspect", "pos", F.posexplode(F.from_json("payload", "array<string>")).alias("_i", "element"))
    return each.select("net", "aspect", (F.shiftleft(F.col("pos").cast("bigint"), 40) + F.col("_i")).alias("ord"), "element")


def normalize(bag: Column, declared: Column) -> Column:
    """``bag`` under its attributes' full names: a value under the alias first, then under the name, then the default.

    Presence counts, not truth, so false, 0 and "" stay. What is not declared passes through. A null bag is empty.
    """
    bag = F.coalesce(bag, F.create_map().cast(_BAG))
    entries = F.coalesce(F.map_entries(declared), F.array().cast(f"array<struct<key:string,value:{_SPEC}>>"))

    def known(e: Column) -> Column:
        alias, name = e["value"]["a"], e["key"]
        value = F.when(F.coalesce(F.array_contains(F.map_keys(bag), alias), F.lit(False)), F.try_element_at(bag, alias)).when(F.array_contains(F.map_keys(bag), name), F.try_element_at(bag, name)).otherwise(e["value"]["v"])
        return F.struct(name.alias("key"), value.alias("value"))

    given = F.filter(F.transform(entries, known), lambda e: e["value"].isNotNull())
    names = F.concat(F.transform(entries, lambda e: e["key"]), F.filter(F.transform(entries, lambda e: e["value"]["a"]), lambda a: a.isNotNull()))
    rest = F.filter(F.map_entries(bag), lambda e: ~F.array_contains(names, e["key"]))
    return F.map_from_entries(F.concat(given, F.transform(rest, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))))


def by_full_name(bag: Column, declared: Column) -> Column:
    """``bag`` with alias keys renamed to full names; defaults are not applied. Of an alias and its name the alias stays."""
    aliases = F.map_from_entries(F.transform(F.filter(F.map_entries(declared), lambda e: e["value"]["a"].isNotNull()), lambda e: F.struct(e["value"]["a"], e["key"])))
    aliases = F.coalesce(aliases, F.create_map().cast(_BAG))
    renamed = F.transform(F.filter(F.map_entries(bag), lambda e: F.map_contains_key(aliases, e["key"])), lambda e: F.struct(F.element_at(aliases, e["key"]).alias("key"), e["value"].alias("value")))
    taken = F.transform(renamed, lambda e: e["key"])
    rest = F.filter(F.map_entries(bag), lambda e: ~F.map_contains_key(aliases, e["key"]) & ~F.array_contains(taken, e["key"]))
    return F.map_from_entries(F.concat(renamed, F.transform(rest, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))))


def _specs(raw: Column) -> Column:
    """Declarations of one kind from their JSON text: malformed entries are left out, a type that is no string is string."""
    entries = F.filter(F.map_entries(F.from_json(raw, _BAG)), lambda e: e["value"].startswith("{"))

    def spec(e: Column) -> Column:
        found = F.from_json(e["value"], _SPEC)
        return F.struct(e["key"].alias("key"), F.struct(F.coalesce(found["d"], F.lit("string")).alias("d"), found["a"].alias("a"), found["v"].alias("v")).alias("value"))

    return F.coalesce(F.map_from_entries(F.transform(entries, spec)), F.create_map().cast(_DECLARED))


def _arrays(aspect: str) -> Column:
    """The values of an aspect that are arrays, in order."""
    return F.filter(F.transform("_objects", lambda m: m[aspect]), lambda p: F.coalesce(p.startswith("["), F.lit(False)))


def _first_object(arrays: Column) -> Column:
    return F.filter(F.transform(arrays, lambda p: F.get(F.from_json(p, "array<string>"), F.lit(0))), lambda x: F.coalesce(x.startswith("{"), F.lit(False)))


def parse(files: DataFrame) -> Networks:
    """``files`` (net, content), one row a file.

    Elements that are no objects are skipped; the last array of nodes and of edges counts; declarations are those of the
    first aspect whose first entry is an object. A context that is no JSON is empty. Malformed files give nothing.
    """
    objects = F.transform(F.filter(F.from_json("content", "array<string>"), lambda e: e.startswith("{")), lambda e: F.from_json(e, _BAG))
    whole = files.select("net", objects.alias("_objects")).where(F.size("_objects") > 0)
    declared = F.from_json(F.get(_first_object(_arrays("attributeDeclarations")), F.lit(0)), _BAG)
    whole = whole.withColumns({"_declared": declared, "_attributes": F.from_json(F.try_element_at(_first_object(_arrays("networkAttributes")), F.lit(-1)), _BAG)})
    whole = whole.withColumns({f"_{k}": _specs(F.col("_declared")[k]) for k in KINDS})
    attributes = normalize(F.col("_attributes"), F.col("_networkAttributes"))
    networks = whole.select("net", F.get(F.filter(F.transform("_objects", lambda m: m["CXVersion"]), lambda v: v.isNotNull()), F.lit(0)).alias("version"), attributes.alias("attributes"), F.col("_nodes").alias("declared_nodes"), F.col("_edges").alias("declared_edges"))
    networks = networks.select("net", "version", F.col("attributes")["name"].alias("name"), F.from_json(F.col("attributes")["@context"], _BAG).alias("context"), "attributes", "declared_nodes", "declared_edges")
    last = lambda aspect, schema: F.from_json(F.try_element_at(_arrays(aspect), F.lit(-1)), schema)
    nodes = whole.select("net", F.col("_nodes").alias("_d"), F.posexplode(last("nodes", NODES)).alias("ord", "_n")).select("net", "ord", "_n.id", "_n.x", "_n.y", "_n.z", normalize(F.col("_n.v"), F.col("_d")).alias("v"))
    edges = whole.select("net", F.col("_edges").alias("_d"), F.posexplode(last("edges", EDGES)).alias("ord", "_e")).select("net", "ord", "_e.id", "_e.s", "_e.t", normalize(F.col("_e.v"), F.col("_d")).alias("v"))
    return Networks(networks, nodes, edges)


def metadata(nets: Networks) -> DataFrame:
    """net, version, name (null if blank), n_nodes and n_edges of each network."""
    count = lambda df, out: df.groupBy("net").agg(F.count("*").alias(out))
    name = F.nullif(F.regexp_replace("name", r"^\s+|\s+$", ""), F.lit(""))
    found = nets.networks.select("net", "version", name.alias("name")).join(count(nets.nodes, "n_nodes"), "net", "left").join(count(nets.edges, "n_edges"), "net", "left")
    return found.fillna(0, ["n_nodes", "n_edges"])


def files(spark: SparkSession, path: str) -> DataFrame:
    """(net, content) of the .cx2 files at ``path`` (a file, folder or glob; one level); each file is one record, named by
    its file name."""
    found = spark.read.option("pathGlobFilter", "*.cx2").text(path, wholetext=True)
    return found.select(F.col("_metadata.file_name").alias("net"), F.col("value").alias("content"))


def read(spark: SparkSession, path: str) -> Networks:
    """The networks of the .cx2 files at ``path``."""
    return parse(files(spark, path))


def cached(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """(net, content) of the networks ``ids`` from a folder of landed files named by id; one that is missing is an error."""
    found = files(spark, path).withColumn("net", F.regexp_replace("net", r"\.cx2$", "")).where(F.col("net").isin(*ids))
    missing = sorted(set(ids) - {r[0] for r in found.select("net").distinct().collect()})
    if missing:
        raise FileNotFoundError(f"not cached at {path}: {', '.join(missing)}")
    return found


def linked_network(found: DataFrame, net: str, link: str, schema_field: str | None = None, schema: str | None = None) -> tuple[str, str | None]:
    """The id of the network that the first network attributes of ``net`` name under ``link``, and a warning if its schema
    is not ``schema``. No such attribute is an error. ``found`` are fragments."""
    payload = single_keyed(found).where((F.col("net") == net) & (F.col("aspect") == "networkAttributes")).select(F.get(F.from_json("payload", "array<map<string,string>>"), F.lit(0)).alias("m")).first()
    attributes = payload.m if payload and payload.m else {}
    if not attributes.get(link):
        raise ValueError(f"{net} has no network attribute {link}")
    off = schema_field and attributes.get(schema_field) != schema
    return attributes[link], f"{schema_field} is {attributes.get(schema_field)!r}, expected {schema!r}" if off else None
