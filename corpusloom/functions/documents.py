"""Titles, platforms and validity of documents, natively on parsed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.errors import permanent
from corpusloom.functions.text import full_trim, none_if_empty

PLATFORM = "struct<name:string,introducedAt:string,deprecatedAt:string,deprecated:boolean,beta:boolean,message:string>"


def _variant(doc: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(doc, path, kind)


def parse(raw_json: Column) -> Column:
    """The document as a variant; NULL for what is no complete JSON."""
    return F.try_parse_json(raw_json)


def parsed(rows: DataFrame, *keep: str, body: str = "raw_json") -> DataFrame:
    """The columns ``keep`` and ``doc``, the parsed document: a column of its own, so that a text is parsed once however often it is looked into."""
    return rows.select(*keep, parse(F.col(body)).alias("doc"))


def platforms(doc: Column) -> Column:
    """Platforms as structs; an element of another shape is NULL inside."""
    items = _variant(doc, "$.metadata.platforms", "array<variant>")
    field = lambda v, name, kind="string": F.try_variant_get(v, f"$.{name}", kind)
    return F.transform(
        items,
        lambda v: F.struct(
            field(v, "name").alias("name"),
            field(v, "introducedAt").alias("introducedAt"),
            field(v, "deprecatedAt").alias("deprecatedAt"),
            field(v, "deprecated", "boolean").alias("deprecated"),
            field(v, "beta", "boolean").alias("beta"),
            field(v, "message").alias("message"),
        ),
    )


def platform_text(p: Column) -> Column:
    """One platform with its versions; '' where there is nothing to say."""
    name, since, until, message = (none_if_empty(p[x]) for x in ("name", "introducedAt", "deprecatedAt", "message"))
    old = F.coalesce(p["deprecated"], F.lit(False))
    version = (
        F.when(until.isNotNull() & since.isNotNull(), F.concat(F.lit(" "), since, F.lit("–"), until, F.lit(" deprecated")))
        .when(since.isNotNull(), F.concat(F.lit(" "), since, F.lit("+")))
        .when(old, F.lit(" deprecated"))
        .otherwise(F.lit(""))
    )
    named = F.concat(name, version, F.when(F.coalesce(p["beta"], F.lit(False)), F.lit(" [Beta]")).otherwise(F.lit("")))
    nameless = F.concat(F.lit("Deprecated"), F.when(message.isNotNull(), F.concat(F.lit(" ("), message, F.lit(")"))).otherwise(F.lit("")))
    return F.when(name.isNotNull(), named).when(old, nameless).otherwise(F.lit(""))


def platform_line(list_of_platforms: Column) -> Column:
    """All platforms, joined by commas; '' if none says anything."""
    texts = F.filter(F.transform(list_of_platforms, platform_text), lambda x: full_trim(x) != "")
    return F.coalesce(F.array_join(texts, ", "), F.lit(""))


def deprecation_note(list_of_platforms: Column) -> Column:
    """The distinct messages of deprecated platforms, in order of appearance."""
    gone = F.filter(list_of_platforms, lambda p: (F.coalesce(p["deprecated"], F.lit(False)) | none_if_empty(p["deprecatedAt"]).isNotNull()) & none_if_empty(p["message"]).isNotNull())
    return F.coalesce(F.array_join(F.array_distinct(F.transform(gone, lambda p: p["message"])), "; "), F.lit(""))


def compose_title(role: Column, title: Column, abstract: Column, list_of_platforms: Column) -> Column:
    """Role and title, abstract, platforms and deprecation note, each on its line; NULL if all are missing. ``abstract`` is an array of texts."""
    role, title = none_if_empty(role), none_if_empty(title)
    head = F.when(role.isNotNull() & title.isNotNull(), F.concat(role, F.lit(": "), title)).otherwise(F.coalesce(title, role, F.lit("")))
    summary = F.coalesce(F.array_join(abstract, ""), F.lit(""))
    line = lambda label, c: F.when(c != "", F.concat(F.lit("\n" + label), c)).otherwise(F.lit(""))
    summary = F.when(full_trim(summary) != "", F.concat(F.lit("\n"), summary)).otherwise(F.lit(""))
    return none_if_empty(full_trim(F.concat(head, summary, line("Platforms: ", platform_line(list_of_platforms)), line("Deprecation Note: ", deprecation_note(list_of_platforms)))))


def document_title(doc: Column) -> Column:
    """The composed title of a parsed document."""
    texts = F.transform(_variant(doc, "$.abstract", "array<variant>"), lambda v: F.try_variant_get(v, "$.text", "string"))
    return compose_title(_variant(doc, "$.metadata.roleHeading", "string"), _variant(doc, "$.metadata.title", "string"), texts, platforms(doc))


def _substantial(section: Column) -> Column:
    text = lambda v, path: none_if_empty(F.try_variant_get(v, path, "string"))
    kind = F.coalesce(text(section, "$.kind"), text(section, "$.type"), F.lit(""))
    content = F.try_variant_get(section, "$.content", "array<variant>")
    real = F.exists(content, lambda item: F.coalesce(text(item, "$.type"), F.lit("")) != "links")
    return (kind != "mentions") & ((kind != "content") | content.isNull() | real)


def validate_document(doc: Column) -> Column:
    """The error of a parsed document, NULL if it holds something of substance. The first failed check counts."""
    def shape(v: Column) -> Column:
        """Type of a value; VOID for what is missing, null, false, zero or empty text."""
        kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
        scalar = ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT")
        text = F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))
        return F.when(scalar & text.isin("", "0", "false"), "VOID").otherwise(kind)

    sections = shape(F.try_variant_get(doc, "$.primaryContentSections", "variant"))
    metadata = shape(F.try_variant_get(doc, "$.metadata", "variant"))
    items = F.try_variant_get(doc, "$.primaryContentSections", "array<variant>")
    is_object = shape(doc).startswith("OBJECT")
    return (
        F.when(doc.isNull() | ~is_object, "Invalid response: not an object")
        .when(sections == "VOID", permanent("NO_PRIMARY_CONTENT", "Missing primaryContentSections field"))
        .when(metadata == "VOID", "Invalid response: missing metadata field")
        .when(~sections.startswith("ARRAY") | (F.coalesce(F.size(items), F.lit(0)) == 0), permanent("NO_SUBSTANTIAL_CONTENT", "Empty sections"))
        .when(~F.exists(items, _substantial), permanent("NO_SUBSTANTIAL_CONTENT", "Only contains mentions or link lists"))
    )
