"""Column expressions for documents (all built-in, JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def person_ref(person_id: Column, name: Column) -> Column:
    """F-4: a person as a nested ``{id, name}`` object."""
    return F.struct(person_id.alias("id"), name.alias("name"))


def when_role(role: Column, wanted: str, value: Column) -> Column:
    """F-2: ``value`` on rows of one role, NULL otherwise (aggregates skip it).
    Case-sensitive; roles other than the three are never picked."""
    return F.when(role == F.lit(wanted), value)


def sorted_refs(refs: Column) -> Column:
    """Distinct persons sorted by id, then name (D-4: a deterministic order)."""
    return F.array_sort(refs)


def names_text(refs: Column) -> Column:
    """F-1 / A-4: names in list order joined by a bare comma. One entry per
    person, so two persons of one name give it twice; NULL names are skipped
    while the person stays in the list (D-5)."""
    return F.array_join(F.transform(refs, lambda p: p["name"]), ",")


def or_empty_list(refs: Column) -> Column:
    """F-3: a film without persons of a role gets an empty list."""
    return F.coalesce(refs, F.array().cast("array<struct<id:string,name:string>>"))


def or_empty_text(value: Column) -> Column:
    """F-3: a film without a director gets an empty string."""
    return F.coalesce(value, F.lit(""))


def refs_as_string_ids(refs: Column) -> Column:
    """Cast nested person ids to the document's string type, keeping order."""
    return F.transform(refs, lambda p: F.struct(p["id"].cast("string").alias("id"),
                                                p["name"].alias("name")))


def refs_text(refs: Column) -> Column:
    """A list as comparable text: ``id:name`` entries joined by ``;``."""
    return F.array_join(
        F.transform(refs, lambda p: F.concat(p["id"].cast("string"), F.lit(":"),
                                             F.coalesce(p["name"], F.lit("")))),
        ";")
