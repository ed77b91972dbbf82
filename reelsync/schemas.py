"""Declared shapes: source columns, target tables, keys, the document.

Nothing is inferred. ``DataFrame.to(schema)`` drops extra columns and
null-fills missing ones, so writes go through :func:`check_strict` instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampType()


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# Target tables (relational schema). uuid -> string, timestamptz -> timestamp.
FILM_WORK = T.StructType([
    _f("id", S, False), _f("title", S, False), _f("description", S),
    _f("creation_date", T.DateType()), _f("rating", T.DoubleType()),
    _f("type", S, False), _f("created", TS), _f("modified", TS),
])
GENRE = T.StructType([
    _f("id", S, False), _f("name", S, False), _f("description", S),
    _f("created", TS), _f("modified", TS),
])
GENRE_FILM_WORK = T.StructType([
    _f("id", S, False), _f("genre_id", S), _f("film_work_id", S), _f("created", TS),
])
PERSON = T.StructType([
    _f("id", S, False), _f("full_name", S), _f("created", TS), _f("modified", TS),
])
PERSON_FILM_WORK = T.StructType([
    _f("id", S, False), _f("person_id", S), _f("film_work_id", S), _f("role", S),
    _f("created", TS),
])

TARGETS: dict[str, T.StructType] = {
    "film_work": FILM_WORK,
    "genre": GENRE,
    "genre_film_work": GENRE_FILM_WORK,
    "person": PERSON,
    "person_film_work": PERSON_FILM_WORK,
}

# Copy order: parents before links, so link checks can see their parents.
COPY_ORDER = ["film_work", "genre", "person", "genre_film_work", "person_film_work"]

# Declared source columns per table (anything else in the source is dropped).
SOURCE_COLUMNS: dict[str, list[str]] = {
    "film_work": ["id", "title", "description", "creation_date", "rating", "type",
                  "created_at", "updated_at"],
    "genre": ["id", "name", "description", "created_at", "updated_at"],
    "genre_film_work": ["id", "genre_id", "film_work_id", "created_at"],
    "person": ["id", "full_name", "created_at", "updated_at"],
    "person_film_work": ["id", "person_id", "film_work_id", "role", "created_at"],
}

# Source -> target renames, by name (the reference pairs them by position).
RENAMES = {"created_at": "created", "updated_at": "modified"}

PRIMARY_KEY: dict[str, list[str]] = {name: ["id"] for name in TARGETS}

# Unique keys besides the primary key.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "film_work": [], "genre": [], "person": [],
    "genre_film_work": [["genre_id", "film_work_id"]],
    "person_film_work": [["person_id", "film_work_id", "role"]],
}

# (link table, column, parent table); parents are keyed by ``id``.
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("genre_film_work", "genre_id", "genre"),
    ("genre_film_work", "film_work_id", "film_work"),
    ("person_film_work", "person_id", "person"),
    ("person_film_work", "film_work_id", "film_work"),
]

# Constraints the relational schema enforces beyond types.
NOT_NULL: dict[str, list[str]] = {
    name: [f.name for f in schema.fields if not f.nullable]
    for name, schema in TARGETS.items()
}
MAX_LENGTH: dict[str, dict[str, int]] = {
    "person": {"full_name": 250},
    "person_film_work": {"role": 250},
}

# The three roles the document knows; anything else is ignored
# and the comparison is case-sensitive.
ROLE_ACTOR = "actor"
ROLE_WRITER = "writer"
ROLE_DIRECTOR = "director"

# The search document (strict at both levels).
PERSON_REF = T.ArrayType(T.StructType([_f("id", S), _f("name", S)]), True)
DOCUMENT = T.StructType([
    _f("id", S, False), _f("imdb_rating", T.DoubleType()), _f("genre", S),
    _f("title", S), _f("description", S), _f("director", S, False),
    _f("actors_names", S, False), _f("writers_names", S, False),
    _f("actors", PERSON_REF, False), _f("writers", PERSON_REF, False),
])

# Progress: one row per entity per pass; NULL position = never run.
HIGH_WATER = T.StructType([
    _f("entity", S, False), _f("position", T.TimestampNTZType()),
    _f("pass_id", T.LongType(), False),
])

ENTITIES = ["genre", "person", "film_work"]


class SchemaMismatch(ValueError):
    """A frame does not have exactly the declared fields and types."""


def _walk(actual: T.DataType, expected: T.DataType, path: str, errors: list[str],
          check_nullable: bool) -> None:
    if isinstance(expected, T.StructType):
        if not isinstance(actual, T.StructType):
            errors.append(f"{path or '<root>'}: expected struct, got {actual.simpleString()}")
            return
        have = {f.name: f for f in actual.fields}
        want = {f.name: f for f in expected.fields}
        for name in want.keys() - have.keys():
            errors.append(f"{path}{name}: missing")
        for name in have.keys() - want.keys():
            errors.append(f"{path}{name}: not in the schema")
        for name in want.keys() & have.keys():
            a, e = have[name], want[name]
            if check_nullable and a.nullable and not e.nullable:
                errors.append(f"{path}{name}: nullable, declared NOT NULL")
            _walk(a.dataType, e.dataType, f"{path}{name}.", errors, check_nullable)
    elif isinstance(expected, T.ArrayType):
        if not isinstance(actual, T.ArrayType):
            errors.append(f"{path[:-1]}: expected array, got {actual.simpleString()}")
            return
        _walk(actual.elementType, expected.elementType, path, errors, check_nullable)
    elif type(actual) is not type(expected):
        errors.append(f"{path[:-1]}: expected {expected.simpleString()}, "
                      f"got {actual.simpleString()}")


def check_strict(actual: T.StructType, expected: T.StructType,
                 check_nullable: bool = False) -> None:
    """Raise :class:`SchemaMismatch` on any extra, missing or retyped field,
    at any depth (structs inside arrays included)."""
    errors: list[str] = []
    _walk(actual, expected, "", errors, check_nullable)
    if errors:
        raise SchemaMismatch("; ".join(sorted(errors)))
