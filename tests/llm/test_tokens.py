import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadstate.llm import bpe, token_files

from llm_fixtures import docs_of  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "a", "b", "é", "Z", "1", "'s", "!", "<|endoftext|>", "<|",
    "中", "😀", "́", "the", " and", "ª", "²",
]
ROWS = [
    (5, "Hello world, it's  fine"), (2, ""), (9, None), (1, "a<|endoftext|> b"), (None, "no id"), (7, "x" * 60_000),
    (5, "again"), (8, " lead\ntrail "), (3, "de la mañana 中文"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n):
    rng = random.Random(2)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(n)]


def test_codec_equals_library(library):
    own = bpe.BytePairCodec(PATH, cache=64)
    for text in [*random_texts(4000), "word " * 500, "y" * 20_000]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_library_encoder_equals_library(library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE", 50)
    own = token_files.LibraryEncoder(PATH)
    texts = random_texts(2000) + ["many words in one line " * 300]
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], own.encode(texts[at : at + 100]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_bpe_rows(docs_of, library):
    got = bpe.bpe_round_trip(docs_of(ROWS), PATH)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t in ROWS]
    assert sorted((repr(r.doc_id), r.n_tokens, bytes(r.ids)) for r in got.collect()) == sorted(
        (repr(i), len(ids), np.array(ids, "<u4").tobytes()) for i, ids in want
    )
    assert bpe.bpe_round_trip(docs_of(ROWS).where("false"), PATH).count() == 0


@pytest.mark.parametrize("width", [1, 5, 16, 17, 31])
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 10_001).astype("<u4")
    packed = token_files.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert (token_files.unpack(packed, len(ids), width) == ids).all()


def test_random_access():
    docs = [(i or None, np.arange(i * 700, dtype="<u4").tobytes()) for i in range(12)]
    data = token_files.segment(docs, 16) + b"\n"
    first, second = token_files.segments(data * 2)
    for i, (row_id, ids) in enumerate(docs):
        assert second.row_id(i) == row_id and second.read_document(i).tobytes() == ids
    assert first.read_range(5000, 5003).tolist() == first.read_range(0, first.ids)[5000:5003].tolist()


def test_files(spark, docs_of, library, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write_token_files(docs_of(ROWS), folder, PATH, 2, file_bytes=20_000)
    got = token_files.read_token_files(spark, folder).collect()
    want, start = [], 0
    by_id = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in by_id:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    rows = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [i for i, _, _ in want]
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    key = lambda x: tuple(map(repr, x))  # noqa: E731  equal ids may come in either order
    assert sorted(((r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in rows), key=key) == sorted(want, key=key)


def test_crc_without_ids(spark, docs_of, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write_token_files(docs_of(ROWS), folder, PATH, 2, file_bytes=20_000)
    whole = token_files.read_token_files(spark, folder)
    narrow = token_files.read_token_files(spark, folder, with_ids=False)
    assert narrow.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    want = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in whole.collect()]
    assert sorted(map(tuple, narrow.collect()), key=repr) == sorted(want, key=repr)


def test_starts_of_many_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILES_A_GROUP", 7)
    sizes = [i * 37 % 11 for i in range(100)]
    files = [(f"part-{i:05d}-x-c000.txt", n) for i, n in enumerate(sizes)]
    got = token_files.file_starts(spark.createDataFrame(files, "file string, ids long").repartition(4)).collect()
    assert {r.file: r.file_start for r in got} == {f: sum(sizes[:i]) for i, (f, _) in enumerate(files)}


def test_tables_are_bounded_by_bytes(library):
    seen = []
    table = bpe.Chunks(lambda c: seen.append(c) or b"1234" * len(c), 1000, limit_bytes=20_000)
    for _ in range(2):
        for i in range(300):
            assert table[f"{i:0100d}"] == b"1234" * 100
    assert len(table) + len(table.old) < 100 and len(seen) > 300
    assert table["x" * 1000] == b"1234" * 1000 and "x" * 1000 not in table
    own = token_files.LibraryEncoder(PATH)
    long = "本" * 5000
    for text, ids in zip([long, f"a {long} b"], own.encode([long, f"a {long} b"]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, own.known)) <= token_files.LONGEST


def test_no_files_for_no_rows(spark, docs_of, tmp_path):
    folder = str(tmp_path / "ids")
    token_files.write_token_files(docs_of(ROWS).where("false"), folder, PATH, 2)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_digests_of_the_query(spark):
    from conftest import SF

    from roadstate.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_bpe"](spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_word_is_encoded_once_per_batch(library, monkeypatch):
    """The library's model sees a piece once, whatever stands around it and however often."""
    own, seen = token_files.LibraryEncoder(PATH), []
    by_model = own.by_model
    monkeypatch.setattr(own, "by_model", lambda pieces: seen.extend(pieces.to_pylist()) or by_model(pieces))
    texts = ["x zyxwv, zyxwv! qrstu\nzyxwv", "x zyxwv; qrstu", "x qrstu, again"]
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(seen) == sorted([" zyxwv", ",", "!", " qrstu", "\n", "zyxwv", ";", " again"])


def test_blanks_and_settled_characters(library):
    """Every character up to the bound, and blanks at all places of words that the table may know."""
    own = token_files.LibraryEncoder(PATH)
    texts = [f"ab {chr(c)} a{chr(c)}b {chr(c)}1 {chr(c)}" for c in range(0x260)]
    blanks = ["", " ", "  ", "\n", " \n", "\n ", "\x1c", "\x85 ", "\xa0", "　 ", "\t\t"]
    texts += [f"{a}ab{b}cd{c}" for a in blanks for b in blanks for c in blanks]
    for _ in range(2):
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert not any(w != w.strip() for w in own.known)
