"""Cleaning, chunking and indexing against plain Python."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlake.operators import chunks, cleaning, index
from wattlake.sources.documents import read_documents

TEXTS = ["", "a", "word " * 700, "x" * 3001, "line one\nline two\n\n" * 90, "é" * 1000, "ab " * 30_000, "p\n" * 401]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def by_doc(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.doc_id, r.pos)):
        out.setdefault(r.doc_id, []).append(r.text)
    return out


@pytest.mark.parametrize("size,overlap", [(1000, 200), (10, 3), (7, 0)])
def test_fixed_chunks(spark, size, overlap):
    got = by_doc(chunks.chunk_fixed(docs(spark, TEXTS), size, overlap))
    for i, text in enumerate(TEXTS):
        n = max(1, math.ceil((len(text) - overlap) / (size - overlap)))
        assert got[i] == [text[k * (size - overlap):k * (size - overlap) + size] for k in range(n)]


def test_token_chunks(spark):
    got = by_doc(chunks.chunk_tokens(docs(spark, TEXTS), 50, 10))
    for i, text in enumerate(TEXTS):
        words = text.split()
        n = max(1, math.ceil((len(words) - 10) / 40))
        assert got.get(i, []) == ([" ".join(words[k * 40:k * 40 + 50]) for k in range(n)] if words else [])


def test_recursive_chunks_run_in_spark(spark):
    got = by_doc(chunks.chunk_recursive(docs(spark, TEXTS)))
    assert got == {i: c for i, t in enumerate(TEXTS) if (c := chunks.split_recursive(t))}


def test_recursive_boundaries():
    split = chunks.split_recursive
    assert split("aaa\n\nbbb\n\nccc", 8, 0) == ["aaa\n\nbbb", "ccc"]
    assert split("aaa bbb ccc ddd", 8, 4) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert split("x" * 25, 10, 2) == ["x" * 10, "x" * 10, "x" * 9]
    assert split("short. " + "y" * 12 + " tail", 10, 0) == ["short.", "y" * 9, "yyy", "tail"]
    assert split("  ", 10, 0) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n", max_size=400), st.integers(5, 60), st.data())
def test_recursive_chunks_cover_the_text(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    parts = chunks.split_recursive(text, size, overlap)
    assert all(0 < len(p) <= size for p in parts)
    # every letter is in some chunk, in order
    letters = [c for c in text if not c.isspace()]
    position, seen = 0, 0
    for p in parts:
        at = text.find(p, max(0, position))
        at = at if at >= 0 else text.find(p)
        assert at >= 0
        position = at
        seen += sum(not c.isspace() for c in p)
    assert seen >= len(letters)
    if overlap == 0:
        assert "".join(c for p in parts for c in p if not c.isspace()) == "".join(letters)


def test_sections_and_metadata(spark):
    text = "intro\n# First\nbody\n## Second part\nmore\fpage two\n# Third\nend"
    sections = chunks.split_sections(docs(spark, [text]))
    rows = sections.orderBy("page_number", "section").collect()
    assert [(r.page_number, r.section_title, r.text.split("\n")[0]) for r in rows] == [
        (1, None, "intro"), (1, "First", "# First"), (1, "Second part", "## Second part"),
        (2, None, "page two"), (2, "Third", "# Third")]
    made = chunks.with_metadata(
        chunks.chunk_fixed(sections), F.lit("v1"), ["more", "imports"], ["page_number", "section", "pos"]).collect()
    row = next(r for r in made if r.section_title == "Second part")
    assert row.tags == ["more"] and row.version == "v1"
    assert row.chunk_id == hashlib.sha256("0|1|2|0|## Second part\nmore".encode()).hexdigest()
    assert len({r.chunk_id for r in made}) == len(made)


def test_cleaning(spark):
    texts = ["Header\n a  b\t\nFooter", "Header\n\n\n\nc\nFooter", "# Header\nHeader\nd\nother", "Footer"]
    frame = docs(spark, texts)
    lines = cleaning.boilerplate_lines(frame, 2)
    assert {r.line: r.n_docs for r in lines.collect()} == {"Header": 3, "Footer": 3}
    want = {0: "a b", 1: "c", 2: "# Header\nd\nother", 3: ""}
    assert {r.doc_id: r.text for r in cleaning.clean_text(frame, lines).collect()} == want
    assert {r.doc_id: r.text for r in cleaning.clean_text(frame).collect()}[0] == "Header\na b\nFooter"


def test_titles_are_kept(spark):
    frame = docs(spark, ["# Title\na", "# Title\nb"])
    cleaned = cleaning.clean_text(frame, cleaning.boilerplate_lines(frame, 2))
    assert {r.text for r in cleaned.collect()} == {"# Title\na", "# Title\nb"}


def test_both_ways_of_matching_lines_give_the_same_rows(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    lines = cleaning.boilerplate_lines(frame, 2, 0.01)
    odd = frame.union(spark.createDataFrame([(1, None), (1, ""), (1, "# a"), (1, "# a"), (None, None)], frame.schema))
    rows = [sorted(map(str, cleaning.clean_text(odd, lines, max_inline_lines=n).collect())) for n in (0, 5000)]
    assert rows[0] == rows[1] and len(rows[0]) == odd.count()
    assert sum("text=None" in r for r in rows[0]) == 2


def test_intake(spark, tmp_path):
    (tmp_path / "a.md").write_text("# T\nbody")
    (tmp_path / "b.TXT").write_text("one\x1etwo")
    rows = {r.doc_type: r for r in read_documents(spark, str(tmp_path)).collect()}
    assert rows["md"].text == "# T\nbody" and rows["md"].version == hashlib.sha256(b"# T\nbody").hexdigest()
    assert rows["md"].source_path.endswith("/a.md") and rows["txt"].text == "one\x1etwo"
    assert {r.text for r in read_documents(spark, str(tmp_path / "b.TXT"), "\x1e").collect()} == {"one", "two"}


def test_index_delta(spark, tmp_path):
    def frame(**texts):
        return index.with_version(spark.createDataFrame(list(texts.items()), "doc_id string, text string"))

    nulls = index.index_delta(frame(a=None, b=None, c=None, d="1"), frame(a=None, b="1", d=None, e=None))
    assert {r.doc_id: r.change for r in nulls.collect()} == {
        "a": "same", "b": "changed", "c": "deleted", "d": "changed", "e": "new"}
    old, new = frame(a="1", b="2", c="3"), frame(b="2", c="4", d="5")
    changes = {r.doc_id: r.change for r in index.index_delta(old, new).collect()}
    assert changes == {"a": "deleted", "b": "same", "c": "changed", "d": "new"}
    applied = index.apply_delta(old, new)
    content = {(r.doc_id, r.text) for r in applied.collect()}
    assert content == {("b", "2"), ("c", "4"), ("d", "5")}
    assert {(r.doc_id, r.text) for r in index.apply_delta(applied, new).collect()} == content
    path = str(tmp_path / "index")
    index.write_snapshot(old, path, 1)
    index.write_snapshot(applied, path, 2)
    assert index.read_snapshot(spark, path, 1).count() == 3
    assert {r.doc_id for r in index.read_snapshot(spark, path, 2).collect()} == {"b", "c", "d"}
