"""Added spans of every kind in texts that hold no other marks."""

from corpuslens.llm import pii
from corpuslens.session import ship_package

#: (kind, hit, text)
ADDED = [
    (0, "ANNA [AT] HOST.COM", "WRITE TO ANNA [AT] HOST.COM THEN"),
    (0, "anna at home dot com", "contact: anna at home dot com"),
    (1, "10[.]0[.]0[.]12", "host 10[.]0[.]0[.]12 the"),
    (1, "abcd:dead:cafe:beef:face:feed:deaf:bead", "ip abcd:dead:cafe:beef:face:feed:deaf:bead the"),
    (1, "2001:db8::1", "host 2001:db8::1 the"),
    (1, "fe80::1a2b:a3c4:5d6e:7f80", "ip fe80::1a2b:a3c4:5d6e:7f80 the"),
    (2, "4111/1111/1111/1111", "card 4111/1111/1111/1111 the"),
    (3, "(555) 010-9999", "call me: (555) 010-9999 the"),
]
PLAIN = ["std::vector and a :: b", "bad::face of 10::30", "WHAT A MAT", "see fig [.] and x"]


def test_added_spans_without_other_marks(spark):
    ship_package(spark)
    rows = [(i, text) for i, (_, _, text) in enumerate(ADDED)] + [(100 + i, text) for i, text in enumerate(PLAIN)]
    got = {r["doc_id"]: r for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {i: [(s["kind"], text[s["start"] : s["stop"]]) for s in got[i]["spans"]] for i, text in rows}
    assert found == {i: [(kind, hit)] for i, (kind, hit, _) in enumerate(ADDED)} | {100 + i: [] for i in range(len(PLAIN))}
