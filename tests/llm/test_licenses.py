"""Operator 12: against a plain search, added and missing words, edge rows."""

import re

from pyspark.sql import functions as F

from reelsync.llm import licenses as L

DOCS = "doc_id long, text string"


def words(text):
    return re.findall(L.WORD, (text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def plain(text):
    """n_words, and (start, label) of the base phrases."""
    w, out = words(text), []
    for t in L.BASE:
        phrase = L.template_words(t)
        out += [(i, t.label) for i in range(len(w)) if w[i:i + len(phrase)] == phrase]
    return len(w), sorted(out)


def test_base_places_match_a_plain_search(spark, documents, edge):
    mit = "MIT License mit-license, cc by cc by"
    extra = spark.createDataFrame([(-1, mit), (-2, "GNU  General\nPublic License. gnu general public"),
                                   (-3, "ÄMIT License"), (-4, "İmit license éCC BY")], DOCS)
    for docs in (documents.select("doc_id", "text"), edge.select("doc_id", "text"), extra):
        got = sorted(map(repr, L.digest(L.find_licenses(docs), "doc_id").drop("labels", "score").collect()))
        want = []
        for r in docs.collect():
            n, places = plain(r.text)
            starts = [p for p, _ in places]
            want.append((r.doc_id, n, len(places), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted({x for _, x in places}))))
        names = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
        assert got == sorted("Row(" + ", ".join(f"{k}={v!r}" for k, v in zip(names, w)) + ")" for w in want)


def labels(spark, text):
    return [(s.label, s.start, s.end, round(s.score, 2)) for s in
            L.find_licenses(spark.createDataFrame([(1, text)], DOCS)).first().spans]


def test_notices_survive_changed_words(spark):
    notice = next(t for t in L.NOTICES if t.label == "mit").text
    w = notice.split()
    assert labels(spark, "one two " + notice) == [("mit", 2, 2 + len(w), 1.0)]
    assert [x[0] for x in labels(spark, " ".join(w[:9] + ["really", "truly"] + w[9:]))] == ["mit"]  # two words more
    assert [x[0] for x in labels(spark, " ".join(w[:9] + w[10:]))] == ["mit"]                       # one less
    assert [x[0] for x in labels(spark, " ".join(w[:9] + ["X"] + w[10:]))] == ["mit"]               # another
    assert labels(spark, " ".join(w[: len(w) // 2])) == []                                          # half of it
    assert labels(spark, " ".join(w[::-1])) == []
    assert [x[0] for x in labels(spark, f"{notice} {notice}")] == ["mit", "mit"]
    assert labels(spark, "the software without any free license of the work and of the gnu") == []


def test_versions_need_their_words(spark):
    assert {x[0] for x in labels(spark, "GNU General Public License, Version 3.")} == {"gpl", "gpl-3"}
    assert {x[0] for x in labels(spark, "GNU General Public License, Version 1.")} == {"gpl"}
    assert {x[0] for x in labels(spark, "CC BY-NC 4.0")} == {"cc-by", "cc-by-nc"}


def test_edge_rows(spark, edge, empty):
    assert L.find_licenses(empty).collect() == []
    clash = edge.withColumns({c: F.lit("x") for c in ("row", "id", "words", "p", "t", "template", "spans", "n_words")})
    found = L.find_licenses(clash)
    assert found.columns == ["doc_id", "n_words", "spans"] and found.count() == edge.count()
    long = "apache license " * 30_000
    got = L.digest(L.find_licenses(spark.createDataFrame([(1, long)], DOCS)), "doc_id").first()
    assert (got.n_words, got.n_base, got.last_word, got.labels) == (60_000, 30_000, 59_998, "apache")


def test_custom_templates(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c x e f g h")], DOCS)
    own = [L.Template("own", "a b c d e f g h")]
    assert [len(r.spans) for r in L.find_licenses(docs, templates=own).orderBy("doc_id").collect()] == [1, 1]
    assert [len(r.spans) for r in L.find_licenses(docs, templates=own, least=0.9).orderBy("doc_id").collect()] == [1, 0]
