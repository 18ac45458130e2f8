from marketlane.llm import substring
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents


def plain(rows, min_words=substring.MIN_WORDS):
    """Text left of each distinct (id, text), by one ordered pass."""
    docs = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hash(r[1])))
    first = {}
    for i, t in docs:
        for start, _, words, digest in substring.units(t or ""):
            if words:
                first.setdefault(digest, (i, t, start))
    left = {}
    for i, t in docs:
        parts = [(a, b, w, first[d] != (i, t, a)) for a, b, w, d in substring.units(t or "") if w]
        gone, k = [], 0
        while k < len(parts):
            end = k
            while end < len(parts) and parts[end][3]:
                end += 1
            words = [w for _, _, w, _ in parts[k:end]]
            if words and (max(words) >= min_words or sum(words) >= substring.MIN_RUN):
                gone.append((parts[k][0], parts[end - 1][1]))
            k = end + 1
        out = t
        for a, b in reversed(gone):
            out = out[:a] + out[b:]
        left[i, t] = out
    return left


def test_units_cover_the_text():
    for text in ["", "a", "One. Two!  Three?\n\nFour 3.5 e.g.x", "\n\n", "...", "no end", "x.\r\n y"]:
        spans = [u[:2] for u in substring.units(text)]
        assert "".join(text[a:b] for a, b in spans) == text


def test_whole_table_equals_ordered_pass(spark, small):
    docs = table(spark, small, "documents")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r for r in substring.dedup_report(docs).collect()}
    assert {i: r["text"] for i, r in got.items()} == {i: t for (i, _), t in want.items()}
    original = {i: t for i, t in want}
    for i, r in got.items():
        text = original[i]
        ends = [0, *(x for s in r["removed"] for x in (s["start"], s["stop"])), len(text)]
        assert "".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])) == r["text"]
        assert r["n_removed"] == len(r["removed"])


PASSAGE = "\n".join(f"The line number {k} of a passage that two documents share in full here." for k in range(5))


def test_a_passage_inside_a_line_goes_from_the_later_document(spark):
    rows = [(2, f"Some words before {PASSAGE} and some after. Own end."), (1, f"Another start. {PASSAGE}"), (3, "Own text only. Own end.")]
    got = {r["doc_id"]: r["text"] for r in substring.dedup_documents(documents(spark, rows)).collect()}
    assert PASSAGE in got[1] and got[3] == rows[2][1]
    assert "number 2 of" not in got[2] and got[2].startswith("Some words before") and got[2].endswith("Own end.")


def test_runs_of_short_lines_and_blank_lines_between(spark):
    verse = "\n".join(f"Short line {k} is sung here" for k in range(12))
    broken = "A paragraph of ten words that two of the texts have.\n\nShort one.\n\nShort two.\n"
    rows = [(1, f"Own first.\n{verse}\n"), (2, f"Own second.\n{verse}\n"), (3, f"Own third.\n{broken}"), (4, f"Own fourth.\n{broken}"), (5, "Own.\nShort one.\n")]
    got = {r["doc_id"]: r["text"] for r in substring.dedup_documents(documents(spark, rows)).collect()}
    assert got[1] == rows[0][1] and got[2] == "Own second.\n"
    assert got[3] == rows[2][1] and got[4] == "Own fourth.\n" and got[5] == rows[4][1]


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    got = substring.dedup_documents(docs)
    assert got.columns == docs.columns
    want = plain(ODD)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == sorted(
        (i is None, i or 0, want[i, t] or "") for i, t in ODD
    )
    assert {r["doc_id"]: r["text"] for r in got.collect()}[1] is None
    assert substring.dedup_documents(docs.limit(0)).count() == 0
