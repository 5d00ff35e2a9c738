"""The corpus pipeline on the smallest table: what each stage drops, and that
the rest arrives whole."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as entry
from qtrail.llm import packing, quality_ordinal, toxicity_pu
from qtrail.llm.common import tokenizer_file
from qtrail.llm.features import features
from qtrail.llm.queries import quality_ratings
from qtrail.llm.wordmemo import load_tokenizer


def test_stages_keep_columns_and_drop_what_they_should(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("*", "1 AS key", "'x' AS score")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, docs, sf_small).toArrow())
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= docs.count() and kept.select("doc_id").distinct().count() == kept.count()
        docs = kept
    pieces = corpus_pipeline.pack(spark, docs, sf_small)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_copies_and_rows_without_ids(spark, sf_small):
    rows = [(1, "a b c d e f", "k"), (2, "a b c d e f", "k"), (2, "a b c d e f", "k"), (None, "a b c d e f", "k"),
            (None, "g h i j k l", "k"), (7, None, "k"), (8, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = corpus_pipeline.keep_one_of_each(spark, docs, sf_small).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "g h i j k l"), (1, "a b c d e f"), (7, ""), (8, "")]
    assert corpus_pipeline.keep_one_of_each(spark, docs.limit(0), sf_small).count() == 0


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_rows_of_one_id_against_brute_force(spark, sf_small):
    base = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(6)]
    near = [t.replace("w59", "x") for t in base]
    rows = [(5, base[0]), (5, base[1]), (5, base[1]), (2, base[2]), (5, near[2]), (9, near[0]), (5, base[3]), (5, near[3]),
            (None, base[4]), (None, near[1]), (5, ""), (5, None), (4, None), (None, base[5]), (11, near[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    sets, group = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same = rows[i][0] == rows[j][0] and (rows[i][1] or "") == (rows[j][1] or "")
            if same or a and b and len(a & b) * 100 >= 80 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    want = [(min(i if i is not None else 1 << 62 for (i, _), h in zip(rows, group) if h == g), g) for g in set(group)]
    kept = corpus_pipeline.keep_one_of_each(spark, docs, sf_small).collect()
    got = [(r.doc_id if r.doc_id is not None else 1 << 62, group[rows.index((r.doc_id, r.text))]) for r in kept]
    assert sorted(got) == sorted(want)


def test_whole_pipeline_against_a_plain_version(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    ratings = quality_ratings(spark, sf_small).where(toxicity_pu.fold() != 0)
    left = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    stage = spark.createDataFrame(left, "doc_id long, text string")

    def scores(scorer, name):
        return scorer(list(features([(t or "").encode() for _, t in left])))[name]

    grades = scores(quality_ordinal.train(stage, ratings).scorer(1), "tail_probability")
    left = [d for d, x in zip(left, grades) if x >= 0.5]
    stage = spark.createDataFrame(left, "doc_id long, text string")
    toxic = scores(toxicity_pu.train(stage, spark.read.parquet(f"{sf_small}/labels.parquet")).scorer(), "score")
    left = sorted(d for d, x in zip(left, toxic) if x < 0.5)
    sets, group, rows = [shingles(t) for _, t in left], list(range(len(left))), {}
    for i, a in enumerate(sets):
        for j in sorted({j for s in a for j in rows.get(s, ())}):
            if group[j] != group[i] and len(a & sets[j]) * 100 >= 80 * len(a | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
        for s in a:
            rows.setdefault(s, []).append(i)
    left = [left[g] for g in sorted(set(group))]  # sorted by id: the first of a group is its smallest
    tok = load_tokenizer(tokenizer_file("word_bpe_49k.json"))
    want = []
    for i, t in left:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        want += [(i, at, ids[at:at + packing.CAPACITY].tobytes()) for at in range(0, ids.size, packing.CAPACITY)]
    got = corpus_pipeline.run(spark, sf_small).collect()
    assert sorted((r.doc_id, r.start, bytes(r.ids)) for r in got) == sorted(want)


def test_last_stage_returns_whole_sequences(spark, sf_small):
    texts = {i: f"word{i} again, " * n for i, n in enumerate((0, 3, 900, 900, 2500, 40))}
    docs = spark.createDataFrame([*texts.items(), (3, texts[3])], "doc_id long, text string")
    sequences = {}
    for r in corpus_pipeline.pack(spark, docs, sf_small).collect():
        sequences.setdefault(r.sequence_id, []).append(r)
    found = {}
    for parts in sequences.values():  # each sequence laid out as one array, then cut again
        parts.sort(key=lambda r: r.offset)
        laid = np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts])
        assert laid.size <= packing.CAPACITY
        for r in parts:
            found.setdefault((r.doc_id, r.start), []).append(laid[r.offset:r.offset + r.length].tolist())
    tok = load_tokenizer(tokenizer_file("word_bpe_49k.json"))
    want = {}
    for i, t in [*texts.items(), (3, texts[3])]:
        ids = [*tok.encode(t, add_special_tokens=False).ids, packing.END_ID]
        for at in range(0, len(ids), packing.CAPACITY):
            want.setdefault((i, at), []).append(ids[at:at + packing.CAPACITY])
    assert found == want


def test_checksum_is_that_of_the_packed_ids(spark, sf_small, monkeypatch):
    pack = packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **b: pack(*a, **b).withColumn("ids", F.encode(F.lit("x"), "utf-8")))
    assert {r.ids_crc32 for r in entry.queries()["op2_packing"](spark, sf_small).collect()} == {zlib.crc32(b"x")}


def test_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
