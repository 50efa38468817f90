import re

from eventlake.llm import license_scan
from eventlake.llm.queries import op4_license_scan
from tests.conftest import SF01
from tests.llm.conftest import doc_frame

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    words = PATTERN.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op4_license_scan(spark, SF01).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
        words = PATTERN.findall(docs[r.doc_id].lower())
        for s in r.spans:
            assert 0 <= s.first_word and s.first_word + s.n_words <= len(words)


def test_edited_notices_are_found_with_their_span(spark):
    rows = [(1, "foo Licensd under the GNU Genral Public Licence bar"),
            (2, "x y Permission is hereby grantd, free of charge to any persn obtaining a copy of this sofware z"),
            (3, "nothing here but a license of the public"),
            (4, "Released undr the MIT Licence.")]
    got = {r.doc_id: r for r in license_scan.scan(doc_frame(spark, rows)).collect()}
    assert got[1].labels == "gpl" and got[1].n_base == 0
    assert (got[1].spans[0].first_word, got[1].spans[0].n_words) == (1, 7)
    assert got[1].spans[0].edits == 3 and 0.9 < got[1].score < 1
    assert got[2].labels == "mit" and (got[2].spans[0].first_word, got[2].spans[0].n_words) == (2, 16)
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].labels == "mit"


def test_seeds_keep_one_piece_under_the_edit_bound():
    for text, _, edits in license_scan.NOTICES:
        pieces = license_scan.seeds(text, edits)
        assert len(pieces) == edits + 1 and b"".join(p for p, _ in pieces) == text.encode()
        assert all(len(p) >= 5 for p, _ in pieces)


def test_edges(spark):
    rows = [(1, None), (1, None), (None, ""), (2, " .,;\n"), (3, "MIT License mit license MIT license"),
            (4, "é mit\tlicense ü"), (5, "mit licenses cc  by"), (6, "a " * 50_000 + "cc by")]
    df = doc_frame(spark, rows).withColumnRenamed("lang", "labels").withColumnRenamed("source", "spans")
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in license_scan.scan(df).collect()]
    expected = [(i, *brute(t)) for i, t in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert license_scan.scan(doc_frame(spark, [])).collect() == []


def test_edits_may_be_characters_of_several_bytes():
    for text in ("gnu g\u2014eneral p\u2014ublic l\u2014icense version", "gnu general p\U0001f600ublic l\U0001f600icense v\U0001f600ersion"):
        found = license_scan.Scanner().scan(f"see the {text} here".encode())
        assert found[5] == "gpl" and [(s["first_word"], s["n_words"], s["edits"]) for s in found[7]] == [(2, 5, 3)]
