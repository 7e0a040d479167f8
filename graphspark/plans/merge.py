"""Many network files merged into one: nodes by what they represent, edges by content, then by pair and direction."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphspark.functions import evidence as E
from graphspark.functions import identifiers as I
from graphspark.operators import dedup
from graphspark.operators.positions import dense_positions, grid_layout
from graphspark.sinks import cx2 as sink
from graphspark.sources import cx2
from graphspark.storage import store

# Attributes whose lists are united, aliases and types of attributes that no file declares.
LISTS = ("alias", "member")
NODE_ALIASES, EDGE_ALIASES = {"name": "n", "represents": "r"}, {"interaction": "i"}
EDGE_TYPES = {"__relationship_score": "double", "__directed": "boolean", "__reverse_directed": "boolean"}
RELATIONS = "Relationships"
_AGENTS = ("subject=([^&]+)&object=([^&]+)", "agent0=([^&]+)&agent1=([^&]+)")
#: How far the ring of pathway nodes lies from the layout's centre, by its span; the step of the grid, and its distance.
RING, STEP, BELOW = 0.75, 30.0, 50.0


class Merged:
    """The merge of ``files`` (net, content); each table is worked out, and written to the shared folder, when it is asked for.

    nodes (id, key, v), edges (id, s, t, v), membership (id, file), places (node, x, y, z), declared (kind, name, ord, spec),
    files (file, net), attributes (v), kept (aspect, payload: opaque aspects), skipped (file, id: edges without their nodes),
    counts (input, duplicates, output of the edges). Values of ``v`` are JSON texts. See ``merge``.
    """

    def __init__(self, files: DataFrame, slim: bool, collapse: bool, pathway_nodes: bool, uuids: DataFrame | None, uuid_field: str, uuid_prefix: str):
        self._given, self._slim, self._collapse, self._pathways = files, slim, collapse, pathway_nodes
        self._uuids, self._uuid_field, self._uuid_prefix = uuids, uuid_field, uuid_prefix

    @cached_property
    def _numbered(self) -> DataFrame:
        return store(indexed_files(self._given), "files")

    @cached_property
    def files(self) -> DataFrame:
        return self._numbered.select("file", "net")

    @cached_property
    def _found(self) -> DataFrame:
        return store(cx2.fragments(self._numbered).join(self.files, "net"), "fragments")

    @cached_property
    def _elements(self) -> DataFrame:
        return store(cx2.concatenated(self._found, ("nodes", "edges", "cartesianLayout")).join(self.files, "net"), "elements")

    @cached_property
    def _known(self) -> DataFrame:
        """The files' own nodes with their key and the id that it was given (unified)."""
        raw = self._elements.where("aspect = 'nodes'").select("file", "ord", F.from_json("element", "struct<id:bigint,x:double,y:double,z:double,v:variant>").alias("n")).select("file", "ord", "n.*")
        bag = F.coalesce(_bag(), F.create_map().cast("map<string,string>"))
        # Each name is read once, as a column of its own: within a key's expression it would be read again wherever it stands.
        names = ("represents", "r", "name", "n")
        read = raw.withColumn("_m", bag).select("file", "ord", "id", "x", "y", "z", "v", *[F.get_json_object(F.concat(F.lit('{"x":'), F.try_element_at("_m", F.lit(k)), F.lit("}")), "$.x").alias(f"_{k}") for k in names])
        plain = F.create_map(*[x for k in names for x in (F.lit(k), F.col(f"_{k}"))])
        nodes = read.select("file", "ord", "id", "x", "y", "z", "v", I.node_key(plain, F.col("id"), F.col("file")).alias("key"))
        heads = nodes.groupBy("key").agg(F.min(F.struct("file", "ord")).alias("_first"))
        ids = dense_positions(heads, ["_first"], "unified").select("key", F.col("unified").cast("bigint").alias("unified"))
        return store(nodes.join(ids, "key"), "known")

    @cached_property
    def _merged_nodes(self) -> DataFrame:
        merged = merged_attributes(self._known.select("unified", "file", "ord", "v"), "unified", ["file", "ord"])
        ids = self._known.select("unified", "key").distinct()
        return store(ids.join(merged, "unified", "left").select(F.col("unified").alias("id"), "key", F.coalesce("v", F.create_map().cast("map<string,string>")).alias("v")), "merged")

    @cached_property
    def membership(self) -> DataFrame:
        return self._known.select(F.col("unified").alias("id"), "file").distinct()

    @cached_property
    def _moved(self) -> DataFrame:
        # Of nodes of one file that share an old id, the last is what the id leads to.
        old = self._known.groupBy("file", F.col("id").alias("old")).agg(F.max_by("unified", "ord").alias("unified"))
        edges = self._elements.where("aspect = 'edges'").select("file", "ord", F.from_json("element", "struct<id:bigint,s:bigint,t:bigint,v:variant>").alias("e")).select("file", "ord", "e.*")
        for side in ("s", "t"):
            edges = edges.join(old.select("file", F.col("old").alias(side), F.col("unified").alias(f"_{side}")), ["file", side], "left")
        return store(edges.select("file", "ord", "id", F.col("_s").alias("s"), F.col("_t").alias("t"), "v"), "edges")

    @property
    def _whole(self) -> DataFrame:
        return self._moved.where(F.col("s").isNotNull() & F.col("t").isNotNull())

    @cached_property
    def skipped(self) -> DataFrame:
        return self._moved.where(F.col("s").isNull() | F.col("t").isNull()).select("file", "id")

    @cached_property
    def _unique(self) -> DataFrame:
        place = F.struct("file", "ord")
        unique = self._whole.groupBy("s", "t", dedup.canonical_digest(F.col("v")).alias("_sig")).agg(F.min_by(F.struct("file", "ord", "v"), place).alias("_r")).select("s", "t", "_r.*")
        return store(dense_positions(unique.select("file", "ord", "s", "t", _bag().alias("v")), ["file", "ord"], "pos").drop("file", "ord"), "unique")

    @cached_property
    def _plain_edges(self) -> DataFrame:
        edges = store(_collapsed(self._unique, self._merged_nodes), "collapsed") if self._collapse else self._unique
        out = edges.select(F.col("pos").cast("bigint").alias("id"), "s", "t", "v")
        if self._slim:
            html = _plain(F.col("v"), RELATIONS)
            slimmed = F.transform_values("v", lambda k, x: F.when((k == RELATIONS) & x.startswith('"') & (x != '""'), sink.quoted(E.slim(html))).otherwise(x))
            out = out.withColumn("v", F.when(F.map_contains_key("v", RELATIONS), slimmed).otherwise(F.col("v")))
        return out

    @cached_property
    def _plain_places(self) -> DataFrame:
        return store(_places(self._known, self._elements), "places")

    @cached_property
    def _with_pathways(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return _with_pathways(self._merged_nodes, self._plain_edges, self._plain_places, self.files, self.membership, self._uuids, self._uuid_field, self._uuid_prefix)

    @cached_property
    def nodes(self) -> DataFrame:
        return store(self._with_pathways[0], "nodes") if self._pathways else self._merged_nodes

    @cached_property
    def edges(self) -> DataFrame:
        return store(self._with_pathways[1] if self._pathways else self._plain_edges, "merged_edges")

    @cached_property
    def places(self) -> DataFrame:
        return _complete(self._with_pathways[2] if self._pathways else self._plain_places, self.nodes)

    @cached_property
    def declared(self) -> DataFrame:
        return _declared(self._found, self.nodes, self.edges)

    @cached_property
    def attributes(self) -> DataFrame:
        return _attributes(self._found)

    @cached_property
    def kept(self) -> DataFrame:
        return _kept(self._found)

    @cached_property
    def counts(self) -> dict[str, int]:
        given, unique = self._whole.count(), self._unique.count()
        return {"input": given, "duplicates": given - unique, "output": self._plain_edges.count()}


def indexed_files(files: DataFrame) -> DataFrame:
    """``files`` (net, content) with file: the place of the name in binary order, from 0."""
    return dense_positions(files, ["net"], "file")


def _bag(v: str = "v") -> Column:
    """A variant object as a map of names to JSON texts."""
    return F.transform_values(F.col(v).cast("map<string,variant>"), lambda _, x: F.to_json(x))


def _plain(bag: Column, key: str | Column) -> Column:
    """The string behind a JSON text of a bag; null if it is none or empty."""
    value = F.try_element_at(bag, F.lit(key) if isinstance(key, str) else key)
    return F.nullif(F.get_json_object(F.concat(F.lit('{"x":'), value, F.lit("}")), "$.x"), F.lit(""))


def merged_attributes(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``key`` and v: of each attribute of ``rows`` (key, order, v) the first value, present ones that are null included; of
    ``LISTS`` the items of all lists in order, each once, where the first value is a list and there is more than one."""
    each = rows.select(key, *order, F.explode(_bag()).alias("name", "value"))
    at = F.struct(*order)
    first = each.groupBy(key, "name").agg(F.min_by(F.coalesce("value", F.lit("null")), at).alias("value"))
    lists = each.where(F.col("name").isin(*LISTS) & F.col("value").startswith("["))
    many = lists.groupBy(key, "name").agg(F.count("*").alias("_n")).where("_n > 1").select(key, "name")
    # Elements stay JSON: an array of variants, each as text.
    items = lists.join(many, [key, "name"]).select(key, "name", *order, F.posexplode(F.transform(F.from_json("value", "array<variant>"), lambda x: F.to_json(x))).alias("_i", "item"))
    united = dedup.first_list(items, [key, "name"], "item", [*order, "_i"], "_items").select(key, "name", F.concat(F.lit("["), F.array_join("_items", ","), F.lit("]")).alias("_list"))
    both = first.join(united, [key, "name"], "left")
    value = F.when(F.col("value").startswith("["), F.coalesce("_list", "value")).otherwise(F.col("value"))
    return both.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", value)))).alias("v"))


def merge(files: DataFrame, slim: bool = True, collapse: bool = True, pathway_nodes: bool = False, uuids: DataFrame | None = None, uuid_field: str = "network_id", uuid_prefix: str = "network") -> Merged:
    """Merge ``files`` (net, content), one row a file.

    Arrays of one aspect are strung together. Nodes merge by their key (``identifiers.node_key``), ids are dense by first
    appearance. Edges follow their nodes, those without go to ``skipped``; edges that agree in ends and attributes count
    once, numbers that are equal being equal however written. With ``collapse`` a pair of nodes keeps one edge for each
    direction that its evidence names, with ``slim`` evidence keeps only what is read of it. With ``pathway_nodes`` each file
    becomes a node that is joined to what came from it, named with its id in ``uuids`` (name, uuid) by whole file name or by
    the name without its ending.
    """
    return Merged(files, slim, collapse, pathway_nodes, uuids, uuid_field, uuid_prefix)


def _collapsed(edges: DataFrame, bags: DataFrame) -> DataFrame:
    """pos, s, t and v of ``edges`` (pos, s, t, v) after the collapse."""
    name = F.coalesce(_plain(F.col("v"), "n"), _plain(F.col("v"), "name"))
    by_name = bags.select(name.alias("_name"), "id").where(F.col("_name").isNotNull()).groupBy("_name").agg(F.min("id").alias("_id"))
    items = edges.select("pos", F.posexplode_outer(E.items(_plain(F.col("v"), RELATIONS))).alias("i", "item")).where(F.col("item").isNotNull())
    url = F.col("item.url")
    ends = F.when(url.rlike(_AGENTS[0]), F.struct(*[F.regexp_extract(url, _AGENTS[0], k) for k in (1, 2)])).when(url.rlike(_AGENTS[1]), F.struct(*[F.regexp_extract(url, _AGENTS[1], k) for k in (1, 2)]))
    items = items.withColumn("_ends", ends).select("pos", "i", "item", F.col("_ends").getField("col1").alias("_a"), F.col("_ends").getField("col2").alias("_b"))
    for end, out in (("_a", "ds"), ("_b", "dt")):
        items = items.join(by_name.select(F.col("_name").alias(end), F.col("_id").alias(out)), end, "left")
    found = dedup.collapse_by_direction(edges.select("pos", "s", "t"), items.select("pos", "i", "item", "ds", "dt"))
    numbered = dense_positions(found, ["pair_pos", "place"], "_new")
    rows = numbered.join(edges.select(F.col("pos").alias("edge"), "v"), "edge")
    html = sink.quoted(E.items_html(F.coalesce("found", F.array().cast(dict(rows.dtypes)["found"]))))
    had, some = F.map_contains_key("v", RELATIONS), F.size(F.coalesce("found", F.array().cast(dict(rows.dtypes)["found"]))) > 0
    others = F.map_filter("v", lambda k, _: k != RELATIONS)
    united = F.when(some | had, F.map_concat(others, F.create_map(F.lit(RELATIONS), html))).otherwise(F.col("v"))
    return rows.select(F.col("_new").cast("bigint").alias("pos"), "s", "t", F.when(F.col("single"), F.col("v")).otherwise(united).alias("v"))


def _places(known: DataFrame, elements: DataFrame) -> DataFrame:
    """(node, x, y, z): each node's first coordinates, of the node itself or, where it has no x, of its file's layout."""
    layout = elements.where("aspect = 'cartesianLayout'").select("file", "ord", F.from_json("element", "struct<node:bigint,x:double,y:double,z:double>").alias("c")).where(F.col("c.node").isNotNull())
    layout = layout.groupBy("file", F.col("c.node").alias("id")).agg(F.max_by("c", "ord").alias("_c"))
    both = known.join(layout, ["file", "id"], "left")
    place = F.when(F.col("x").isNull(), F.struct("_c.x", "_c.y", "_c.z")).otherwise(F.struct("x", "y", "z"))
    placed = both.withColumn("_p", place).where(F.col("_p.x").isNotNull() & F.col("_p.y").isNotNull())
    return placed.groupBy(F.col("unified").alias("node")).agg(F.min_by("_p", F.struct("file", "ord")).alias("_p")).select("node", "_p.*")


def extent(places: DataFrame) -> DataFrame:
    """One row: least and greatest x and y, the centre and the greater span (1 at least); zeros where there are no places."""
    zero = F.lit(0.0)
    ends = places.agg(*[F.coalesce(f(c), zero).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))])
    return ends.withColumns({"centre_x": (F.col("min_x") + F.col("max_x")) / 2, "centre_y": (F.col("min_y") + F.col("max_y")) / 2, "span": F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(1.0))})


def _complete(places: DataFrame, bags: DataFrame) -> DataFrame:
    """``places`` with a place on a grid below the layout for every node that has none."""
    missing = bags.join(places, bags["id"] == places["node"], "left_anti").select(F.col("id").alias("node"))
    grid = grid_layout(missing, ["node"], STEP).join(F.broadcast(extent(places)))
    return places.select("node", "x", "y", "z").union(grid.select("node", F.col("min_x") + F.col("x"), F.col("max_y") + BELOW + F.col("y"), F.lit(None).cast("double")))


def file_ids(names: DataFrame, uuids: DataFrame | None) -> DataFrame:
    """``names`` (file, net) with uuid: of ``uuids`` (name, uuid) by the whole file name, else by the name without ending."""
    if uuids is None:
        return names.withColumn("uuid", F.lit(None).cast("string"))
    table = uuids.groupBy("name").agg(F.max("uuid").alias("uuid"))
    whole = table.select(F.col("name").alias("net"), F.col("uuid").alias("_whole"))
    stem = table.select(F.col("name").alias("_stem"), F.col("uuid").alias("_by_stem"))
    named = names.withColumn("_stem", stem_of_file(F.col("net"))).join(whole, "net", "left").join(stem, "_stem", "left")
    return named.select("file", "net", F.coalesce(F.nullif("_whole", F.lit("")), "_by_stem").alias("uuid"))


def stem_of_file(name: Column) -> Column:
    """A file name without its last ending; a name that only has a dot in front stays."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def _with_pathways(bags, edges, places, names, membership, uuids, uuid_field: str, uuid_prefix: str):
    tops = bags.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("_top"))
    stem = stem_of_file(F.col("net"))
    own = F.create_map(F.lit("n"), sink.quoted(stem), F.lit("r"), sink.quoted(F.concat(F.lit("pathway:"), stem)), F.lit("type"), F.lit('"pathway"'))
    named = F.map_concat(own, F.create_map(F.lit(uuid_field), sink.quoted(F.concat(F.lit(f"{uuid_prefix}:"), "uuid"))))
    paths = file_ids(names, uuids).join(F.broadcast(tops)).select(
        (F.col("_top") + 1 + F.col("file")).cast("bigint").alias("id"), F.concat(F.lit("__pathway__"), F.col("file").cast("string")).alias("key"), F.when(F.coalesce(F.col("uuid") != "", F.lit(False)), named).otherwise(own).alias("v"), "file"
    )
    paths = store(paths, "pathways")
    top_edge = edges.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("_top"))
    links = dense_positions(membership.join(paths.select("file", F.col("id").alias("_path")), "file"), ["id", "file"], "_n").join(F.broadcast(top_edge))
    links = links.select((F.col("_top") + 1 + F.col("_n")).cast("bigint").alias("id"), F.col("_path").alias("s"), F.col("id").alias("t"), F.create_map(F.lit("i"), F.lit('"participates in"')).alias("v"))
    n = F.greatest(F.lit(1), F.lit(paths.count()))
    angle = 2 * F.pi() * F.col("file") / n
    ring = paths.join(F.broadcast(extent(places))).select(
        F.col("id").alias("node"), (F.col("centre_x") + F.col("span") * RING * F.cos(angle)).alias("x"), (F.col("centre_y") + F.col("span") * RING * F.sin(angle)).alias("y"), F.lit(None).cast("double").alias("z")
    )
    return bags.select("id", "key", "v").union(paths.select("id", "key", "v")), edges.union(links), places.select("node", "x", "y", "z").union(ring)


def first_declarations(found: DataFrame) -> DataFrame:
    """(kind, name, ord, spec): of each declared attribute the first file's declaration, as JSON text."""
    first = F.get(F.from_json("payload", "array<string>"), F.lit(0))
    # Arrays of one file are strung together, so the first one's first element counts.
    own = found.where("aspect = 'attributeDeclarations'").where(F.col("payload").startswith("[")).groupBy("net", "file").agg(F.min_by(first, "pos").alias("_d"))
    kinds = own.where(F.col("_d").startswith("{")).select("file", F.explode(F.from_json("_d", "map<string,string>")).alias("kind", "_m")).where(F.col("kind").isin(*cx2.KINDS))
    each = kinds.select("file", "kind", F.posexplode(F.map_entries(F.from_json("_m", "map<string,string>"))).alias("_i", "_e"))
    at = F.struct("file", "_i")
    return each.groupBy("kind", F.col("_e.key").alias("name")).agg(F.min(at).alias("ord"), F.min_by("_e.value", at).alias("spec"))


def undeclared(rows: DataFrame, declared: DataFrame, aliases: dict[str, str], types: dict[str, str]) -> DataFrame:
    """(name, spec): a declaration for each attribute of ``rows`` (id, v) that ``declared`` (name, spec) has neither as a name
    nor as an alias; a list is a list of strings, others have the type of ``types`` or are strings."""
    taken = declared.select(F.col("name")).union(declared.select(F.get_json_object("spec", "$.a")).where(F.get_json_object("spec", "$.a").isNotNull()))
    first = rows.select("id", F.explode("v").alias("name", "value")).groupBy("name").agg(F.min_by(F.coalesce(F.col("value").startswith("["), F.lit(False)), "id").alias("_list"))
    new = first.join(taken.distinct(), "name", "left_anti")
    kind = F.when(F.col("_list"), "list_of_string").otherwise(F.coalesce(F.try_element_at(I.literal_map(types), F.col("name")), F.lit("string")) if types else F.lit("string"))
    alias = F.try_element_at(I.literal_map(aliases), F.col("name"))
    return new.select("name", F.to_json(F.struct(kind.alias("d"), alias.alias("a"))).alias("spec"))


def _declared(found: DataFrame, bags: DataFrame, edges: DataFrame) -> DataFrame:
    given = store(first_declarations(found), "declared")
    late = F.struct(F.lit(1 << 40).cast("bigint").alias("file"), F.lit(0).alias("_i"))
    out = given.select("kind", "name", F.col("ord").cast("struct<file:bigint,_i:int>").alias("ord"), "spec")
    for kind, rows, aliases, types in (("nodes", bags, NODE_ALIASES, {}), ("edges", edges, EDGE_ALIASES, EDGE_TYPES)):
        own = undeclared(rows, given.where(F.col("kind") == kind), aliases, types)
        out = out.union(own.select(F.lit(kind), "name", late, "spec"))
    return out


def _first_payload(found: DataFrame, aspect: str) -> DataFrame:
    """(payload): the value of ``aspect`` in the first file that has it; within a file as it is strung together."""
    return found.where(F.col("aspect") == aspect).agg(F.min_by("payload", F.struct("file", "pos")).alias("payload")).where(F.col("payload").isNotNull())


def _attributes(found: DataFrame) -> DataFrame:
    """(v): the network attributes of the first file that has any, as a map of names to JSON texts."""
    first = F.get(F.from_json(_one("payload"), "array<variant>"), F.lit(0))
    return _first_payload(found, "networkAttributes").select(F.transform_values(first.cast("map<string,variant>"), lambda _, x: F.to_json(x)).alias("v"))


def _one(column: str) -> Column:
    return F.when(F.col(column).startswith("["), F.col(column)).otherwise(F.concat(F.lit("["), F.col(column), F.lit("]")))


def _kept(found: DataFrame) -> DataFrame:
    """(aspect, payload): visual aspects, which pass through unread."""
    out = None
    for aspect in ("visualProperties", "visualEditorProperties"):
        one = _first_payload(found, aspect).select(F.lit(aspect).alias("aspect"), "payload")
        out = one if out is None else out.union(one)
    return out


def document(merged: Merged, name: str, description: str) -> DataFrame:
    """The lines of the merged file: declarations, attributes, nodes, edges, layout, visual aspects."""
    declared = {k: {} for k in cx2.KINDS}
    # Declarations, attributes and visual aspects are those of a schema: small, whatever the number of nodes.
    for r in merged.declared.orderBy("ord", "name").collect():
        declared[r.kind][r.name] = r.spec
    import json

    attributes = dict((r.v if (r := merged.attributes.first()) else None) or {}) | {"name": json.dumps(name), "description": json.dumps(description)}
    aliases = {json.loads(s).get("a") for s in declared["networkAttributes"].values() if s.startswith("{")}
    for k in attributes:
        if k not in declared["networkAttributes"] and k not in aliases:
            declared["networkAttributes"][k] = '{"d":"string"}'
    obj = lambda m: "{" + ",".join(f"{json.dumps(k)}:{v}" for k, v in m.items()) + "}"
    aspects = [
        ("attributeDeclarations", f"[{obj({k: obj(m) for k, m in declared.items()})}]"), ("networkAttributes", f"[{obj(attributes)}]"),
        ("nodes", merged.nodes.select(F.col("id").alias("ord"), sink.node_json().alias("json"))),
        ("edges", merged.edges.select(F.col("id").alias("ord"), sink.edge_json().alias("json"))),
        ("cartesianLayout", merged.places.select(F.col("node").alias("ord"), sink.place_json().alias("json"))),
    ]
    extra = {}
    for r in merged.kept.collect():
        aspects.append((r.aspect, r.payload))
        extra[r.aspect] = len(json.loads(r.payload)) if r.payload.startswith("[") else 1
    return sink.document(aspects, extra)
