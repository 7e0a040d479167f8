"""Identifier expressions: IRIs, CURIEs, slugs and member-set identities. All are column expressions of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where minted identifiers and the graph's own terms live, unless a caller names other places.
BASE, VOCABULARY = "https://example.org/graph/", "https://example.org/graph/vocabulary/"
# Standard prefixes, in the order in which they are tried.
STANDARD_PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "owl": "http://www.w3.org/2002/07/owl#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "RO": "http://purl.obolibrary.org/obo/RO_",
    "GO": "http://purl.obolibrary.org/obo/GO_",
    "SO": "http://purl.obolibrary.org/obo/SO_",
    "SIO": "http://semanticscience.org/resource/SIO_",
    "obo": "http://purl.obolibrary.org/obo/",
    "pubchem": "http://rdf.ncbi.nlm.nih.gov/pubchem/compound/CID",
}
# Fixed value: the stem of evidence statements, which is tried last.
EVIDENCE_PREFIX = {"indra": "https://db.indra.bio/statements/"}
# Stems of the registry that lie below a network's own context.
REGISTRY_PREFIXES = {"uniprot": "http://purl.uniprot.org/uniprot/", "chebi": "http://purl.obolibrary.org/obo/CHEBI_"}
# Class of a node type, and class that an identifier's prefix entails.
SIO, OBO = "http://semanticscience.org/resource/SIO_", "http://purl.obolibrary.org/obo/"
TYPE_CLASS = {
    "protein": f"{SIO}010043",
    "proteinfamily": f"{SIO}001380",
    "complex": f"{SIO}010497",
    "antibody": f"{SIO}010465",
    "signal": f"{SIO}010438",
    "gene": f"{OBO}SO_0000704",
    "variant": f"{OBO}SO_0001060",
    "mrna": f"{OBO}SO_0000234",
    "mirna": f"{OBO}SO_0000276",
    "lncrna": f"{OBO}SO_0001877",
    "rnareference": f"{OBO}SO_0000655",
    "rna": f"{OBO}CHEBI_33697",
    "smallmolecule": f"{OBO}CHEBI_23367",
    "chemical": f"{OBO}CHEBI_24431",
    "drug": f"{OBO}CHEBI_23888",
    "disease": f"{OBO}MONDO_0000001",
    "phenotype": f"{OBO}UPHENO_0001001",
    "cellularcomponent": f"{OBO}GO_0005575",
    "biologicalprocess": f"{OBO}GO_0008150",
    "molecularfunction": f"{OBO}GO_0003674",
    "tissue": f"{OBO}UBERON_0000479",
    "stimulus": f"{OBO}NCIT_C41210",
}
PREFIX_CLASS = {"uniprot": f"{SIO}010043", "chebi": f"{OBO}CHEBI_23367"}


def own_prefixes(base: str = BASE, vocabulary: str = VOCABULARY) -> dict[str, str]:
    """The standard prefixes, those of the graph's own places, and that of evidence statements."""
    return STANDARD_PREFIXES | {"graph": base, "graphv": vocabulary} | EVIDENCE_PREFIX


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def trimmed(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def safe_iri(c: Column) -> Column:
    """Percent-encodes what may not stand in an IRI: control characters, space and <>"{}|^`\\."""
    escaped = F.transform(F.split(c, ""), lambda x: F.when(x.rlike(r'[\x00-\x20<>"{}|\\^`]'), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x))
    return F.when(c.rlike(r'[\x00-\x20<>"{}|\\^`]'), F.array_join(escaped, "")).otherwise(c)


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")


def prefix_of(c: Column) -> Column:
    return F.substring_index(c, ":", 1)


def is_bare(c: Column) -> Column:
    return F.instr(c, ":") == 0


def hash8(c: Column) -> Column:
    """FNV-1a over characters (of the basic plane), 32 bits, as eight hexadecimal digits."""
    step = lambda h, x: (h.bitwiseXOR(x) * F.lit(16777619)).bitwiseAND(F.lit(4294967295))
    codes = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("long"))
    return F.lpad(F.lower(F.hex(F.aggregate(codes, F.lit(2166136261).cast("long"), step))), 8, "0")


def family_iri(name: Column, members: Column, base: str = BASE) -> Column:
    """Identity by the set of members; by name alone where there are none."""
    set_ = F.array_sort(F.filter(F.transform(members, lambda m: F.lower(trimmed(m))), lambda m: m != ""))
    slug = F.coalesce(F.nullif(slugify(name), F.lit("")), F.lit("family"))
    named = F.concat(F.lit(f"{base}family/"), slug)
    return F.when(F.size(set_) > 0, F.concat(named, F.lit("-"), hash8(F.array_join(set_, "|")))).otherwise(named)


def entity_iri(name: Column, base: str = BASE) -> Column:
    return F.concat(F.lit(f"{base}entity/"), slugify(name))


def pathway_iri(uuid: Column, name: Column, base: str = BASE) -> Column:
    given = F.nullif(trimmed(uuid), F.lit(""))
    return F.concat(F.lit(f"{base}pathway/"), F.coalesce(given, slugify(clean_pathway_name(name))))


def clean_pathway_name(c: Column) -> Column:
    """Without a version marker at the end. The pattern is a fixed value."""
    return trimmed(F.regexp_replace(c, r"(?i)\s*_v\d+(?:[._]\d+)*_?\s*$", ""))


def statement_iri(base: Column, edge: Column, index: Column) -> Column:
    return F.concat(base, F.lit("statement_"), edge.cast("string"), F.lit("_"), index.cast("string"))


def resolve_prefix(prefix: Column, prefixes: Column) -> Column:
    """The stem of a prefix: exact match first, then the first in the map that is equal but for case."""
    near = F.element_at(F.filter(F.map_entries(prefixes), lambda e: F.lower(e["key"]) == F.lower(prefix)), 1)["value"]
    return F.coalesce(F.try_element_at(prefixes, prefix), F.when(F.exists(F.map_keys(prefixes), lambda k: F.lower(k) == F.lower(prefix)), near))


def expand(curie: Column, prefixes: Column) -> Column:
    """http(s) IRIs as they are; a known prefix, up to the first colon, is expanded; else unchanged."""
    stem = F.when(~is_bare(curie), resolve_prefix(prefix_of(curie), prefixes))
    web = curie.startswith("http://") | curie.startswith("https://")
    return F.when(web, curie).when(stem.isNotNull(), F.concat(stem, F.substr(curie, F.instr(curie, ":") + 1))).otherwise(curie)


def split_curie(curie: Column) -> Column:
    """prefix (null for a bare name) and local part, split at the first colon."""
    return F.struct(F.when(~is_bare(curie), prefix_of(curie)).alias("prefix"), F.when(is_bare(curie), curie).otherwise(F.substr(curie, F.instr(curie, ":") + 1)).alias("local"))


def has_prefix(curie: Column, prefixes: Column) -> Column:
    """If the part before the first colon is a known prefix, in any case."""
    return F.coalesce(~is_bare(curie) & resolve_prefix(prefix_of(curie), prefixes).isNotNull(), F.lit(False))


def is_resolvable(curie: Column, prefixes: Column) -> Column:
    return F.coalesce(curie.startswith("http://") | curie.startswith("https://"), F.lit(False)) | has_prefix(curie, prefixes)


def ontology_iri(prefix: str, term: Column) -> Column:
    """The IRI of a term of one of the standard ontologies (RO, GO, SIO, ...), given with its prefix or without."""
    return F.concat(F.lit(STANDARD_PREFIXES[prefix]), F.regexp_replace(term, f"^{prefix}:", ""))


def compact(iri: Column, prefixes: Column) -> Column:
    """With the first prefix, in order, whose stem begins the IRI; else unchanged."""
    fits = F.filter(F.map_entries(prefixes), lambda e: iri.startswith(e["value"]))
    first = F.get(fits, 0)
    return F.when(F.size(fits) > 0, F.concat(first["key"], F.lit(":"), F.substr(iri, F.length(first["value"]) + 1))).otherwise(iri)


def turtle_term(iri: Column, prefixes: Column) -> Column:
    """A CURIE of a known prefix (in its exact case) as it is; a full IRI with the first prefix that begins it; else the IRI
    in angle brackets."""
    known = ~is_bare(iri) & ~iri.startswith("http") & F.map_contains_key(prefixes, prefix_of(iri))
    short = compact(iri, prefixes)
    return F.when(known, iri).when(short != iri, short).otherwise(F.concat(F.lit("<"), iri, F.lit(">")))


def type_class(kind: Column, identifier: Column) -> Column:
    """Class of a type in any case, else what the identifier's prefix entails, else null: nothing is guessed."""
    return F.coalesce(F.try_element_at(literal_map(TYPE_CLASS), F.lower(kind)), F.try_element_at(literal_map(PREFIX_CLASS), F.lower(prefix_of(identifier))))


def escape_literal(c: Column) -> Column:
    for raw, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def safe_file_name(c: Column) -> Column:
    """Path separators, wild cards, quotes, colons, pipes and angle brackets become _, runs of white space one space; no dots
    in front; 180 characters at most."""
    plain = F.translate(c, '\\/:*?"<>|', "_" * 9)
    return F.left(F.regexp_replace(trimmed(F.regexp_replace(plain, r"\s+", " ")), r"^\.+", ""), F.lit(180))


def local_name(c: Column) -> Column:
    """An identifier with - for its colons, as the local part of a CURIE."""
    return F.replace(c, F.lit(":"), F.lit("-"))


def turtle_curie(curie: Column, known: dict[str, str], context: Column) -> Column:
    """The Turtle term of a CURIE: as it is if its prefix is ``known`` in this very case, else by the network's context in
    angle brackets; null for a bare name and for a prefix that neither has."""
    prefix = prefix_of(curie)
    stem = F.try_element_at(context, prefix)
    own = F.concat(F.lit("<"), stem, F.substr(curie, F.instr(curie, ":") + 1), F.lit(">"))
    return F.when(is_bare(curie), F.lit(None)).when(prefix.isin(*known), curie).when(stem != "", own)


def exact_iri(curie: Column, known: dict[str, str], context: Column) -> Column:
    """The IRI of a CURIE by a ``known`` prefix in this very case, else by the network's context; null for a bare name and for
    a prefix that neither has."""
    prefix, local = prefix_of(curie), F.substr(curie, F.instr(curie, ":") + 1)
    stem = F.coalesce(F.try_element_at(literal_map(known), prefix), F.nullif(F.try_element_at(context, prefix), F.lit("")))
    return F.when(~is_bare(curie), F.concat(stem, local))


def stem_of(uri_format: Column) -> Column:
    """A registry format without its $1 at the end; null if that is not where it stands."""
    return F.when(uri_format.endswith("$1"), F.substr(uri_format, F.lit(1), F.length(uri_format) - 2))


def node_key(v: Column, id_: Column, file: Column) -> Column:
    """What a node merges by: the first of represents, r, name, n that is not empty, else the id; a bare name only within its
    file. ``v`` maps names to strings."""
    known = F.coalesce(*[F.nullif(F.try_element_at(v, F.lit(k)), F.lit("")) for k in ("represents", "r", "name", "n")], id_.cast("string"))
    return F.when(is_bare(known), F.concat(F.lit("__file"), file.cast("string"), F.lit("__"), known)).otherwise(known)


def double_lexical(x: Column) -> Column:
    """A double in the shortest decimal form, with an exponent only below 1e-4 and from 1e16 on: 0.0005, 4.887e-05, 1e+16.

    Digits are those of the JVM's conversion; nan and inf are written so.
    """
    text = F.abs(x).cast("string")
    mantissa, exponent = F.substring_index(text, "E", 1), F.substring_index(text, "E", -1).try_cast("int")
    digits = F.regexp_replace(F.replace(mantissa, F.lit("."), F.lit("")), "0+$", "")
    high = F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), "0")
    whole, rest = F.substr(high, F.lit(1), exponent + 1), F.substr(high, exponent + 2)
    above = F.concat(whole, F.lit("."), F.when(rest == "", "0").otherwise(rest))
    below = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    tail = F.substr(digits, F.lit(2))
    scientific = F.concat(F.left(digits, F.lit(1)), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)), F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"))
    plain = F.when(~F.contains(text, F.lit("E")), text).when(exponent.between(0, 15), above).when(exponent.between(-4, -1), below).otherwise(scientific)
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    return F.when(F.isnan(x), "nan").otherwise(F.concat(sign, F.when(F.abs(x) == float("inf"), "inf").otherwise(plain)))


def typed(value: Column, datatype: str) -> Column:
    """A Turtle literal with its datatype written out."""
    return F.concat(F.lit('"'), value.cast("string"), F.lit(f'"^^{datatype}'))
