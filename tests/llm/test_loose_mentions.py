"""Every repeated mailbox is a node of the field, and documents with loose mentions only have a field."""

from collections import Counter

from cartwheel.llm import personal

PLAIN = "Mail johnsmith@ex.org. Later johnsmith, (JohnSmith) and johnsmith2 or al@ex.org, al"
MIXED = "Write to ann1234567890@ex.org; ann1234567890 knows"


def found(text):
    return [(text[n.start : n.end], n.kind) for n in personal.nodes_of(text, personal.base_spans(text))]


def test_plain_and_short_mailboxes_are_nodes():
    assert found(PLAIN) == [("johnsmith@ex.org", 0), ("johnsmith", -1), ("JohnSmith", -1), ("al@ex.org", 0), ("al", -1)]
    _, skip = personal.links(personal.nodes_of(PLAIN, personal.base_spans(PLAIN)))
    assert skip == [(0, 1), (0, 2), (1, 2), (3, 4)]
    assert found(MIXED) == [("ann1234567890@ex.org", 0), ("ann1234567890", -1)]
    assert personal.links(personal.nodes_of(MIXED, personal.base_spans(MIXED)))[1] == [(0, 1)]


def test_plain_mailbox_is_added(docs_of):
    text = "Mail johnsmith@ex.org or bob.t@ex.org. Later johnsmith wrote"
    r = personal.find_personal_data(docs_of([(1, text)])).first()
    assert [text[s["start"] : s["end"]] for s in r["spans"] if s not in r["base"]] == ["johnsmith"]


def test_loose_mentions_without_a_base_span(docs_of):
    """Two loose runs look as 200 phones do, in a document without a base span."""
    rows = [(i, f"call +1 (202) 555-{i:04d} now") for i in range(200)] + [(900, "call 1 (202) 555-0150 or 1 (202) 555-0150"), (901, "no 12345")]
    got = {r["doc_id"]: r for r in personal.find_personal_data(docs_of(rows)).collect()}
    assert not got[900]["base"] and [s["kind"] for s in got[900]["spans"]] == ["phone", "phone"] and not got[901]["spans"]
    total = sum((personal.counted(t) for _, t in rows), Counter())
    field = personal.Field(sorted((*k, n) for k, n in total.items()))
    assert len(field.spans(rows[200][1])[1]) == 2
