"""Edge goldens for document building (FIXTURES.md section 6) and properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelsync.operators.documents import build_documents, enrich_fanout
from reelsync.schemas import DOCUMENT, check_strict
from reelsync.sources.fixtures import film_tables

from .conftest import SF_SMALL, film, make_tables


def docs_by_id(df):
    return {r["id"]: r.asDict(recursive=True) for r in df.collect()}


def test_edge_goldens(spark):
    t = make_tables(
        spark,
        films=[film("f1"), film("f2"), film("f3"), film("f4"), film("f5"), film("f6"),
               film("f7")],
        persons=[("p1", "Alice", None), ("pB", "Bob", None), ("pA", "Ann", None),
                 ("pn", None, None), ("s1", "Sam", None), ("s2", "Sam", None),
                 ("pw", "Wendy", None), ("px", "Xavier", None)],
        person_links=[
            ("p1", "f1", "director"),                      # D-1 sole director
            ("pB", "f2", "director"), ("pA", "f2", "director"),   # D-2 two directors
            ("pn", "f4", "actor"), ("p1", "f4", "actor"),  # D-5 NULL name
            ("s1", "f5", "actor"), ("s2", "f5", "actor"),  # A-4 one name twice
            ("pw", "f6", "actor"), ("pw", "f6", "writer"),  # D-16 both roles
            ("px", "f6", "producer"), ("px", "f6", "ACTOR"),  # D-14 ignored roles
        ],
        genres=[("g1", "Drama", None), ("g2", "Action", None)],
        genre_links=[("g1", "f1"), ("g1", "f3"), ("g2", "f3")],   # D-3 several genres
    )
    docs = build_documents(t)
    check_strict(docs.schema, DOCUMENT)
    d = docs_by_id(docs)
    assert d["f1"]["director"] == "Alice" and d["f1"]["genre"] == "Drama"
    assert d["f2"]["director"] == "Bob"
    assert d["f3"]["genre"] == "Action"
    assert d["f4"]["actors"] == [{"id": "p1", "name": "Alice"}, {"id": "pn", "name": None}]
    assert d["f4"]["actors_names"] == "Alice"
    assert d["f5"]["actors_names"] == "Sam,Sam"
    assert [a["id"] for a in d["f5"]["actors"]] == ["s1", "s2"]
    assert d["f6"]["actors"] == [{"id": "pw", "name": "Wendy"}]
    assert d["f6"]["writers"] == [{"id": "pw", "name": "Wendy"}]
    # D-15: no links at all
    assert d["f7"] == {"id": "f7", "imdb_rating": 1.0, "genre": None, "title": "t",
                       "description": None, "director": "", "actors_names": "",
                       "writers_names": "", "actors": [], "writers": []}


def test_duplicate_links_do_not_duplicate_persons(spark):
    t = make_tables(spark, films=[film("f1")],
                    persons=[("p1", "Al", None)],
                    person_links=[("p1", "f1", "actor"), ("p1", "f1", "actor")],
                    genres=[("g1", "A", None), ("g2", "B", None)],
                    genre_links=[("g1", "f1"), ("g2", "f1")])
    d = docs_by_id(build_documents(t))
    assert d["f1"]["actors"] == [{"id": "p1", "name": "Al"}]
    assert d["f1"]["actors_names"] == "Al"
    # the fan-out form repeats the person once per genre
    assert enrich_fanout(t).count() == 4


def nest_fanout(rows):
    """Python nesting of fan-out rows with the build's decisions (D-1..D-5)."""
    out = {}
    for r in rows:
        d = out.setdefault(r["id"], {"actors": set(), "writers": set(), "director": None,
                                    "genre": None})
        role = r["person_role"]
        p = (r["person_id"], r["person_name"])
        if role == "actor":
            d["actors"].add(p)
        elif role == "writer":
            d["writers"].add(p)
        elif role == "director" and r["person_name"] is not None:
            d["director"] = max(d["director"] or r["person_name"], r["person_name"])
        if r["genre_name"] is not None:
            d["genre"] = min(d["genre"] or r["genre_name"], r["genre_name"])
    return {str(k): (sorted((str(a), b) for a, b in v["actors"]),
                     sorted((str(a), b) for a, b in v["writers"]),
                     v["director"] or "", v["genre"]) for k, v in out.items()}


def test_branch_aggregation_equals_nested_fanout(spark):
    t = film_tables(spark, SF_SMALL)
    expected = nest_fanout(enrich_fanout(t).collect())
    got = {r["id"]: ([(a["id"], a["name"]) for a in r["actors"]],
                     [(a["id"], a["name"]) for a in r["writers"]], r["director"], r["genre"])
           for r in build_documents(t).collect()}
    assert got.keys() == expected.keys()
    for k in got:
        assert sorted(got[k][0]) == expected[k][0]
        assert sorted(got[k][1]) == expected[k][1]
        assert got[k][2:] == expected[k][2:]


def test_independent_of_partitioning(spark):
    t = film_tables(spark, SF_SMALL)
    a = build_documents(t)
    shuffled = t.replace(
        person_film_work=t.person_film_work.repartition(7).orderBy(F.rand(1)),
        genre_film_work=t.genre_film_work.repartition(3),
        film_work=t.film_work.repartition(5))
    b = build_documents(shuffled)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_restriction_to_ids(spark):
    t = film_tables(spark, SF_SMALL)
    ids = t.film_work.select("id").orderBy("id").limit(5)
    part = build_documents(t, ids)
    full = build_documents(t).join(ids.select(F.col("id").cast("string").alias("id")), "id",
                                   "left_semi")
    assert part.count() == 5
    assert part.exceptAll(full.select(*part.columns)).count() == 0
