from collections import Counter

from roadstate.llm.line_dedup import SeenFilter, hashes_of, line_dedup

from llm_fixtures import docs_of  # noqa: F401

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs, min_length=1):
    seen = Counter()
    for _, t in rows:
        seen.update({key(line) for line in (t or "").split("\n")})
    hot = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_length}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in hot]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


ROWS = [
    (1, "a line\nB line\n\nuniq one"), (2, " A LINE\t\nb line \r\nother"), (3, "a line"), (4, ""), (5, None),
    (6, "b line\nb line\nÉ"), (7, "é\nx\x85"), (None, "a line\nnobody"), (3, "a line"), (8, "\n\n"),
    (9, "long " * 50_000 + "\na line"),
]


def collected(df):
    return sorted(((r.doc_id, r.text, r.line_stats.n_lines, r.line_stats.n_dropped) for r in df.collect()), key=repr)


def test_equals_brute_force(docs_of):
    for min_docs in (2, 3, 4):
        got = line_dedup(docs_of(ROWS), min_docs=min_docs, keep_first=False)
        assert collected(got) == brute(ROWS, min_docs)
        assert got.columns == [*docs_of(ROWS).columns, "line_stats"]


def test_saturated_filter_stays_exact(docs_of):
    got = line_dedup(docs_of(ROWS), min_docs=3, keep_first=False, filter_bits=16)
    assert collected(got) == brute(ROWS, 3)


def test_other_columns_unchanged(docs_of):
    rows = line_dedup(docs_of(ROWS)).collect()
    assert {(r.kept, r.row, r.key, r.n_chars) for r in rows} == {("mine", "r", "k", None)}


def test_first_occurrence_stays(docs_of):
    got = line_dedup(docs_of([(1, "x\ny\nx"), (2, "X\nz"), (3, "w")]), min_docs=2)
    assert [t for _, t, _, _ in collected(got)] == ["x\ny", "z", "w"]


def test_min_length_counts_code_points(docs_of):
    rows = [(i, "éé\nab\nabc") for i in range(3)]
    assert collected(line_dedup(docs_of(rows), min_docs=3, min_length=3, keep_first=False)) == brute(rows, 3, 3)


def test_empty_table(docs_of):
    assert line_dedup(docs_of(ROWS).where("false")).count() == 0


def test_no_repeat_is_missed_by_the_filters():
    seen = SeenFilter(16)
    seen.add(hashes_of([b"k%d" % i for i in range(3000)]))
    seen.add(hashes_of([b"k%d" % i for i in range(2000, 5000)]))
    assert seen.suspects(hashes_of([b"k%d" % i for i in range(2000, 3000)])).all()


def test_own_column_of_the_name_of_the_statistics(spark):
    rows = [(i, "shared line\nown %d" % i, "theirs", "too") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_stats string, LINE_STATS_ string")
    got = line_dedup(docs, min_docs=2, keep_first=False)
    assert got.columns == [*docs.columns, "line_stats__"]
    assert {(r[1], r[2], r[3], r[4].n_dropped) for r in got.collect()} == {(f"own {i}", "theirs", "too", 1) for i in range(3)}
