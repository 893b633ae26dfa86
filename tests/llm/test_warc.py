import gzip
import hashlib
import random

import pytest

from roadstate.llm import warc

from llm_fixtures import pages_of  # noqa: F401

BIG = "<p>é" + "x" * 1200


def build(spark, pages, tmp_path, name="w"):
    folder = str(tmp_path / name)
    warc.write_archives(pages, folder)
    return folder, warc.capture_index(spark, folder)


def brute(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        same = [j for j, _, h in rows if (h or "").encode() == body]
        top = max((j for j in same if j is not None), default=None)
        again = len(body) >= 1000 and len(same) > 1 and top is not None and i != top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example.com/x?q=1#f", BIG), (2, "https://b.example.com", BIG), (3, "http://a.example.com/x", BIG),
    (4, None, "small"), (5, "no scheme\r\nX: y", "small"), (6, "http://h/%0A%25", None), (7, "http://h/", ""),
    (None, "http://h/z", BIG), (8, "http://h/", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"),
    (3, "http://a.example.com/x", BIG), (9, "http://long/", "y" * 400_000),
]


def test_round_trip(spark, pages_of, tmp_path):
    folder, index = build(spark, pages_of(ROWS), tmp_path)
    rows = index.collect()
    got = [(r.row_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == brute(ROWS)
    assert all(r.intact for r in rows)
    assert sorted(r.url_key for r in rows) == sorted(warc.key_of(u or "") for _, u, _ in ROWS)


def test_index_points_into_the_archives(spark, pages_of, tmp_path):
    """Seek to a record by the index and read nothing else of the file."""
    folder, index = build(spark, pages_of(ROWS), tmp_path)
    for r in index.collect():
        with open(f"{folder}/{r.run}", "rb") as f:
            f.seek(r.offset)
            data = f.read(r.length)
        fields, block = warc.read_record(data, 0, r.length)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        assert fields["WARC-Type"] == r.record_type and fields.get("WARC-Record-ID") == (
            None if r.row_id is None else f"<urn:page:{r.row_id}>"
        )
        payload = block.partition(b"\r\n\r\n")[2]
        assert r.record_type == "revisit" and payload == b"" or hashlib.sha1(payload).hexdigest() == r.digest


def test_files_are_gzip_of_bounded_size(spark, pages_of, tmp_path):
    rows = [(i, f"http://h/{i}", f"{i} " + "word " * 300) for i in range(200)]
    folder = str(tmp_path / "w")
    warc.write_archives(pages_of(rows), folder, file_bytes=40_000)
    files = sorted(p for p in (tmp_path / "w").iterdir() if p.name.startswith("part-"))
    whole = [gzip.decompress(p.read_bytes()) for p in files]
    assert len(files) >= 8 and max(map(len, whole)) < 120_000
    assert sum(w.count(b"WARC/1.1\r\nWARC-Type") for w in whole) == 200
    assert sum(1 for _ in warc.capture_index(spark, folder, rows_per_range=30).collect()) == 200


def test_record_beyond_16_mb_ends_in_zero():
    big = b"x" * (17 << 20)
    for record in (b"", b"a", big):
        data = warc.member(record)
        assert data[-1] == 0 and gzip.decompress(data) == record
    contents = [c for _, _, c in warc.archive_members(warc.member(big) + warc.member(b"next"))]
    assert [c for c in contents if c] == [big, b"next"]


def test_damaged_records(spark, pages_of, tmp_path):
    folder, index = build(spark, pages_of(ROWS), tmp_path)
    hit = next(r for r in index.collect() if r.payload_bytes == 5)
    path = tmp_path / "w" / hit.run
    data = path.read_bytes()
    record = gzip.decompress(data[hit.offset : hit.offset + hit.length]).replace(b"small", b"smaLl")
    (tmp_path / "w" / f".{hit.run}.crc").unlink(missing_ok=True)
    path.write_bytes(data[: hit.offset] + warc.member(record) + data[hit.offset + hit.length :])
    with pytest.raises(Exception, match="damaged record"):
        warc.capture_index(spark, folder).collect()
    marked = {(r.row_id, r.intact) for r in warc.capture_index(spark, folder, strict=False).collect()}
    assert (hit.row_id, False) in marked and sum(not ok for _, ok in marked) == 1
    path.write_bytes(path.read_bytes()[:-9])
    with pytest.raises(Exception, match="ends within|record|Error"):
        warc.capture_index(spark, folder, strict=False).collect()


def test_streams_are_ascending_whatever_the_order_of_blocks():
    rng = random.Random(2)
    rows = []
    for run in ("a", "b", "c"):
        part = sorted((f"k{rng.randrange(30):02d}", "t", True, rng.randrange(99)) for _ in range(200))
        blocks = [part[i : i + 37] for i in range(0, 200, 37)]
        rng.shuffle(blocks)
        rows += [[(*r, run, i, 1, 2, "d", "response", None, True) for i, r in enumerate(block)] for block in blocks]
    rng.shuffle(rows)
    incoming = [warc.batch(block, warc.ARROW_CAPTURE) for block in rows]
    found = warc.streams(iter(incoming))
    for stream in found:
        places = [place for place, _ in stream]
        assert places == sorted(places)
    merged = [tuple(r) for b in warc.merge_runs(iter(incoming)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(merged) == 600 and [warc.place_of(r) for r in merged] == sorted(warc.place_of(r) for block in rows for r in block)


def test_columns_with_names_of_the_operator(spark, tmp_path):
    rows = [(i, f"http://h/{i}", BIG, "u", "b", 1, 2) for i in range(4)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, url_key string, body string, row_id int, size int")
    _, index = build(spark, table, tmp_path)
    assert sorted((r.row_id, r.record_type) for r in index.collect()) == [(0, "revisit"), (1, "revisit"), (2, "revisit"), (3, "response")]


def test_index_is_ordered_over_partitions(spark, pages_of, tmp_path):
    rows = [(i, f"http://h{i % 3}.example/{i % 7}", f"t{i}") for i in range(500)]
    _, index = build(spark, pages_of(rows), tmp_path)
    keys = [(r.url_key, r.time, r.row_id) for r in index.collect()]
    assert len(keys) == 500 and keys == sorted(keys)


def test_empty_table(spark, pages_of, tmp_path):
    _, index = build(spark, pages_of(ROWS).where("false"), tmp_path)
    assert index.count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in range(0, 9):
        runs = [sorted(((rng.randint(0, 20),), (i, n)) for n in range(rng.randint(0, 30))) for i in range(k)]
        merged = list(warc.LoserTree(runs))
        assert [m[0] for m in merged] == sorted(x[0] for r in runs for x in r)
        assert sorted(merged) == sorted(x for r in runs for x in r)
