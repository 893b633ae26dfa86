import random
from collections import Counter

import public_tokenizers
from test_decontaminate import brute as contaminated
from test_line_dedup import brute as line_dedup
from test_near_dedup import brute as near
from tokenizers import Tokenizer

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(tmp_path, spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choices("aeiourstln", k=rng.randint(2, 7))) for _ in range(500)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, line(30)) for i in range(6)]
    docs, labels = [], []
    for i in range(240):
        words = line(60).split()
        if i % 6 == 0:
            for _ in range(5):
                words[rng.randrange(60)] = "gru" + rng.choice(vocab)
        labels.append((i, 1, int(i % 6 == 0)))
        docs.append((i, " ".join(words) + ("\nShared footer line" if i % 3 == 0 else "") + "\nown " + line(4)))
    docs += [(300 + i, docs[i][1].replace("own", "Own")) for i in range(1, 30)]
    docs += [(400 + i, line(20) + " " + items[i][1][20:120] + " " + line(20)) for i in range(6)]
    docs += [(500, ""), (501, None), (None, line(30))]
    folder = str(tmp_path)
    full = [(i, t, "xx", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs, items


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, tmp_path):
    folder, docs, items = tables(tmp_path, spark)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]

    def step(name, df):
        out = stages[name](spark, df, folder)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        return spark.read.parquet(path)

    clean = step("toxicity", spark.read.parquet(f"{folder}/documents.parquet"))
    assert clean.columns == COLUMNS
    gone = {i for i, _ in docs} - {i for i, _ in pairs(clean)}
    assert sum(i % 6 == 0 for i in gone if i < 240) >= 32 and sum(i % 6 != 0 for i in gone) <= 8

    lines = step("line_dedup", clean)
    assert lines.columns == COLUMNS
    want = line_dedup(pairs(clean), 10)
    assert Counter(pairs(lines)) == Counter((i, t) for i, t, _, _ in want)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    distinct = step("near_dedup", lines)
    assert distinct.columns == COLUMNS
    kept = {i for i, _, _, k in near(pairs(lines), 5, 80) if k}
    assert Counter(i for i, _ in pairs(distinct)) == Counter(i for i, _ in pairs(lines) if i in kept)

    safe = step("decontamination", distinct)
    assert safe.columns == COLUMNS
    dirty = {r[0] for r in contaminated(pairs(distinct), items) if r[4]}
    assert dirty and Counter(pairs(safe)) == Counter((i, t) for i, t in pairs(distinct) if i not in dirty)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = {r.doc_id: r for r in step("bpe", safe).collect()}
    for i, t in pairs(safe):
        assert coded[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids) and coded[i].decoded == t

    whole = corpus_pipeline.run(spark, folder)
    assert Counter(r.doc_id for r in whole.collect()) == Counter(coded.keys())


def test_one_of_many_copies_keeps_its_text(spark):
    text = "\n".join(f"line {i} of a text that many hold\n---" for i in range(5))
    own = lambda i: f"words of document {i} alone, more of them than the footer has"
    docs = [(i, text) for i in range(100, 125)] + [(None if i == 0 else i, own(i) + "\nfooter") for i in range(12)]
    docs += [(200 + i, text + f"\nedition {i}") for i in range(3)] + [(300, ""), (301, None)]
    rows = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.repeated_lines(spark, rows.repartition(3), "").cache()
    assert lines.columns == COLUMNS and all(r.n_chars == len(r.text or "") for r in lines.collect())
    got = dict(pairs(lines))
    assert [i for i, t in got.items() if t and t.startswith("line 0")] == [100] and got[100] == text
    assert set(got) == {100, 200, 201, 202, 300, 301, None, *range(1, 12)}
    assert all(got[i or None] == own(i) for i in range(12)) and got[201] == "edition 1"
    final = corpus_pipeline.near_duplicates(spark, lines, "")
    assert [t for _, t in pairs(final)].count(text) == 1


def empty_tables(spark, folder, documents):
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.run(spark, empty_tables(spark, str(tmp_path), none)).collect() == []


def test_columns_with_names_of_the_stages(spark, tmp_path):
    names = ["line_stats", "row", "row_id", "kept", "score", "key", "n_tokens", "__gone", "predicted"]
    rows = [(i, f"document number {i} says something of its own {i * 7}\nfooter", *[f"{n}{i}" for n in names]) for i in range(12)]
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    folder = empty_tables(spark, str(tmp_path), spark.createDataFrame(rows, schema))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", *names], name
    got = {r.doc_id: r for r in docs.collect()}
    assert len(got) == 12
    for i, r in got.items():
        assert r.text == rows[i][1].removesuffix("\nfooter") and tuple(r)[2:] == rows[i][2:]
    assert stage_rows(spark, docs, folder) == 12


def stage_rows(spark, docs, folder):
    return corpus_pipeline.encode(spark, docs, folder).count()
