"""Evidence items: the HTML lists of relations, their statement URLs and what relation types map to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .identifiers import literal_map, trimmed

# Fixed value: one item, with its text, URL and count.
ITEM = r'<li/>([^<]+)\(<a\s+href="([^"]+)"[^>]*>(\d+)</a>\)'
# One item and nothing else, whose URL states a relation without anything to decode: URL, subject, object, type and count. Of a
# parameter the first place counts, which an atomic group holds to; the bound keeps the match from going deep.
_FIRST = "".join(rf'(?=(?>(?:[^"&#]*&){{0,50}}?{name}=)([^"&#%+]+)[&#"])' for name in ("subject", "object", "type"))
PLAIN = rf'\A<li/>[^<]+\(<a\s+href="([A-Za-z][A-Za-z0-9+.-]*:[^"?#]*\?{_FIRST}[^"#]*(?:#[^"]*)?)"[^>]*>(\d+)</a>\)\z'
_MARK = "\x01"
# Verbs and the relation types that they state.
VERB_TYPE = {
    "binds": "Complex",
    "activates": "Activation",
    "inhibits": "Inhibition",
    "phosphorylates": "Phosphorylation",
    "dephosphorylates": "Dephosphorylation",
    "sumoylates": "Sumoylation",
    "desumoylates": "Desumoylation",
    "ubiquitinates": "Ubiquitination",
    "deubiquitinates": "Deubiquitination",
    "acetylates": "Acetylation",
    "deacetylates": "Deacetylation",
    "methylates": "Methylation",
    "demethylates": "Demethylation",
    "increases the amount of": "IncreaseAmount",
    "decreases the amount of": "DecreaseAmount",
    "translocates": "Translocation",
}
# Predicate and process of a relation type.
RO, GO = "http://purl.obolibrary.org/obo/RO_", "http://purl.obolibrary.org/obo/GO_"
TYPE_PREDICATE = {
    "Complex": f"{RO}0002436",
    "Activation": f"{RO}0002629",
    "IncreaseAmount": f"{RO}0002629",
    "Inhibition": f"{RO}0002630",
    "DecreaseAmount": f"{RO}0002630",
    "Phosphorylation": f"{RO}0002578",
    "Dephosphorylation": f"{RO}0002578",
    "Sumoylation": f"{RO}0002578",
    "Desumoylation": f"{RO}0002578",
    "Ubiquitination": f"{RO}0002578",
    "Deubiquitination": f"{RO}0002578",
    "Acetylation": f"{RO}0002578",
    "Deacetylation": f"{RO}0002578",
    "Methylation": f"{RO}0002578",
    "Demethylation": f"{RO}0002578",
    "Translocation": f"{RO}0002410",
}
TYPE_PROCESS = {
    "Phosphorylation": f"{GO}0006468",
    "Dephosphorylation": f"{GO}0006470",
    "Sumoylation": f"{GO}0016925",
    "Desumoylation": f"{GO}0016926",
    "Ubiquitination": f"{GO}0016567",
    "Deubiquitination": f"{GO}0016579",
    "Acetylation": f"{GO}0006473",
    "Deacetylation": f"{GO}0016575",
    "Methylation": f"{GO}0006479",
    "Demethylation": f"{GO}0006482",
    "Translocation": f"{GO}0015031",
}
DEFAULT_PREDICATE = f"{RO}0002211"


def predicate_iri(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(TYPE_PREDICATE), kind), F.lit(DEFAULT_PREDICATE))


def process_iri(kind: Column) -> Column:
    return F.try_element_at(literal_map(TYPE_PROCESS), kind)


def has_mapping(kind: Column) -> Column:
    """If the relation type is one of the table; others get the default predicate."""
    return F.coalesce(kind.isin(*TYPE_PREDICATE), F.lit(False))


def verb_label(kind: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map({t: v for v, t in VERB_TYPE.items()}), kind), F.lit("interacts with"))


def _query(url: Column) -> Column:
    """What stands between the first ? and the # of an absolute URL; null where there is none."""
    before = F.substring_index(url, "#", 1)
    at = F.instr(before, "?")
    return F.when((at > 0) & url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.substr(before, at + 1))


def _parameter(query: Column, name: str) -> Column:
    led, mark = F.concat(F.lit("&"), query), f"&{name}="
    at = F.instr(led, mark)
    found = F.substring_index(F.substr(led, at + len(mark)), "&", 1)
    plain = F.when(F.contains(found, F.lit("%")) | F.contains(found, F.lit("+")), F.try_url_decode(F.replace(found, F.lit(" "), F.lit("%20")))).otherwise(found)
    return F.nullif(F.when(at > 0, plain), F.lit(""))


def url_parameter(url: Column, name: str) -> Column:
    """A query parameter, decoded; null where there is none or it is empty. Raw spaces are allowed; a # ends the query."""
    return _parameter(_query(url), name)


def text_relation(text: Column) -> Column:
    """subject, object and kind of a sentence of two words and a verb between them; null where it is none."""
    # One match; the mark cannot stand in a word, and a text that does not match has no parts.
    pattern, mark = rf"(?i)^(\w+)\s+({'|'.join(VERB_TYPE)})\s+(\w+)$", "\x01"
    parts = F.when(text.rlike(r"^\w+\s"), F.split(F.regexp_replace(text, pattern, f"{mark}$1{mark}$2{mark}$3"), mark))
    kinds = literal_map(VERB_TYPE)
    one = F.get(F.transform(F.array(parts), lambda p: F.when(F.size(p) == 4, F.struct(F.get(p, F.lit(1)).alias("subject"), F.get(p, F.lit(3)).alias("object"), F.try_element_at(kinds, F.lower(F.get(p, F.lit(2)))).alias("kind")))), F.lit(0))
    return F.when(text.isNotNull(), one)


def items(html: Column) -> Column:
    """Array of (text, url, n) of all items in order; null for null."""
    return F.transform(_matches(html), lambda x: F.struct(*_item(x)))


def _matches(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(ITEM), F.lit(0))


def _item(x: Column) -> tuple[Column, Column, Column]:
    """Text, URL and count of a match."""
    # In a match the text has no <, so the first two after <li/> are those of the link and of its end.
    link = F.substr(x, F.instr(x, "(<a") + 3)
    text = F.substr(x, F.lit(6), F.instr(x, "(<a") - 6)
    n = F.substring_index(F.substring_index(x, "</a>", 1), ">", -1)
    return text.alias("text"), F.substring_index(F.substring_index(link, '"', 2), '"', -1).alias("url"), n.cast("bigint").alias("n")


def relations(html: Column) -> Column:
    """Array of (subject, object, kind, n, url) of the items that state a relation: by URL, else by text; others are left out."""
    return _relations(_matches(html))


def _relations(matches: Column) -> Column:
    """Each step is an array of its own, made once: what a lambda gets is a value, where a column would be worked out again
    wherever it is referred to."""

    def by_url(x: Column) -> Column:
        params = F.get(F.transform(F.array(_query(x["url"])), lambda q: F.struct(*[_parameter(q, p).alias(p) for p in ("subject", "object", "type")])), F.lit(0))
        return F.struct(x.alias("x"), params.alias("p"))

    def whole(y: Column) -> Column:
        x, p = y["x"], y["p"]
        stated = p["subject"].isNotNull() & p["object"].isNotNull() & p["type"].isNotNull()
        link = F.struct(p["subject"].alias("subject"), p["object"].alias("object"), p["type"].alias("kind"))
        return F.struct(F.when(stated, link).otherwise(text_relation(trimmed(x["text"]))).alias("r"), x["n"].alias("n"), x["url"].alias("url"))

    found = F.transform(matches, lambda x: F.struct(*_item(x)))
    made = F.filter(F.transform(F.transform(found, by_url), whole), lambda z: z["r"].isNotNull())
    return F.transform(made, lambda z: F.struct(z["r"]["subject"].alias("subject"), z["r"]["object"].alias("object"), z["r"]["kind"].alias("kind"), z["n"].alias("n"), z["url"].alias("url")))


def exploded_outer(df: DataFrame, html: str | Column, *keep: str) -> DataFrame:
    """``keep`` columns, i (place among the relations of the row) and r (a relation), one row a relation; r is null for a row
    that states none.

    What most rows have is one item with a plain link: one match gives its parts, in compiled columns; all others are read in
    lambdas.
    """
    html = F.col(html) if isinstance(html, str) else html
    found = df.select(*keep, html.alias("_h"))
    found = found.select("*", F.split(F.regexp_replace("_h", PLAIN, "".join(f"{_MARK}${k}" for k in range(1, 6))), _MARK).alias("_p"))
    url, subject, object_, kind, n = [F.get("_p", F.lit(k)) for k in range(1, 6)]
    link = F.struct(subject.alias("subject"), object_.alias("object"), kind.alias("kind"), n.cast("bigint").alias("n"), url.alias("url"))
    # A text that holds the mark itself is not taken apart by it.
    single = F.coalesce((F.size("_p") == 6) & ~F.contains("_h", F.lit(_MARK)), F.lit(False))
    found = found.select(*keep, F.when(single, F.array(link)).otherwise(_relations(_matches(F.col("_h")))).alias("_r"))
    return found.select(*keep, F.posexplode_outer("_r").alias("i", "r"))


def exploded(df: DataFrame, html: str | Column, *keep: str) -> DataFrame:
    """``exploded_outer`` without the rows that state no relation.

    An outer explode, filtered after it: an inner one would infer a filter that works the relations out once more.
    """
    return exploded_outer(df, html, *keep).where(F.col("r").isNotNull())


def evidence_urls(html: Column) -> Column:
    """The URLs of all items, in order."""
    return F.transform(items(html), lambda x: x["url"])


def evidence_count(text: Column) -> Column:
    """The number between > and </a> at the end of an item; null where there is none."""
    return F.nullif(F.regexp_extract(text, r">(\d+)</a>\)?$", 1), F.lit("")).cast("bigint")


def total_evidence(html: Column) -> Column:
    """The counts of all items together; 0 where there is none."""
    return F.coalesce(F.aggregate(items(html), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]), F.lit(0))


def slim(html: Column) -> Column:
    """The least HTML with the same items; null stays null."""
    return F.when(html.isNotNull(), items_html(items(html)))


def items_html(found: Column) -> Column:
    """The least HTML that gives the same items."""
    return F.array_join(F.transform(found, lambda x: F.concat(F.lit("<li/>"), x["text"], F.lit('(<a href="'), x["url"], F.lit('">'), x["n"].cast("string"), F.lit("</a>)"))), "")
