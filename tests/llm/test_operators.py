"""The operators against plain versions in Python, on small made-up tables
with nulls, empty and odd texts, ties, repeated rows and extra columns."""

import gzip
import hashlib
import io
import random
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from qtrail.llm import ann_multi_index as ann
from qtrail.llm import chat_format as chat
from qtrail.llm import features, ngram_join, packing, piece_lattice, quality_ordinal, spotsigs, token_counts, toxicity_pu, warc_zip
from qtrail.llm.common import ship_package, tokenizer_file
from qtrail.llm.components import components
from qtrail.llm.count_rtree import CountRTree, count_vector, fold, may_link, needed
from qtrail.llm.wordmemo import load_tokenizer

ODD = [None, "", " ", "a", "  a  b ", "a b\n\n c", "x<|endoftext|>y <|endoftext|>", "it's  word's 's", "é́ ①ﬁ", "naïve Große, I.",
       "日本語 text", " lead", "trail ", "a\tb \tc", "\x1c a\x1cb", "<|im_end|><|im_start|>assistant ok", "<\\|x", "a 1 22b, c3."]


@pytest.fixture(scope="module")
def spark(spark):
    ship_package(spark)
    return spark


def docs_of(spark, texts):
    rows = [(i, t, "en", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, row int")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ODD + [prose(rng, n) + ". End,\nnew" for n in (3, 50, 700, 3000)] + ["word " * 9000, "x" * 5000, "a", "a"]


def test_token_counts_equal_the_library(spark, texts):
    tok = load_tokenizer(tokenizer_file("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs_of(spark, texts)).collect()}
    want = {i: (len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    assert got == want
    assert token_counts.token_counts(docs_of(spark, texts).limit(0)).count() == 0


def test_cutting_stock_past_its_refreshes_beside_a_session(spark):
    """Enough classes for over 400 pivots, so the basis is inverted anew twice."""
    rng = random.Random(3)
    demand = {w: rng.randrange(1, 60) ** 2 for w in range(1, 129)}
    steps = []
    known = packing.inverted
    packing.inverted = lambda m: steps.append(1) or known(m)
    try:
        plan = packing.cutting_stock(demand, 128)
    finally:
        packing.inverted = known
    assert len(steps) >= 2
    assert all(sum(w * c for w, c in pattern.items()) <= 128 for pattern, _ in plan)
    assert all(sum(pattern.get(w, 0) * n for pattern, n in plan) >= need for w, need in demand.items())
    used = sum(n for _, n in plan)
    assert used <= 1.05 * sum(w * n for w, n in demand.items()) / 128 + 1
    m = np.array([[rng.random() for _ in range(40)] for _ in range(40)])
    assert np.allclose((packing.inverted(m)[:, :, None] * m[None]).sum(1), np.eye(40), atol=1e-7)


def test_packing_places_every_id_once(spark, texts):
    tok = load_tokenizer(tokenizer_file("word_bpe_49k.json"))
    rows = packing.pack_documents(docs_of(spark, texts), capacity=256).collect()
    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in mine for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(r.ids) for r in mine)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 256
    assert packing.pack_documents(docs_of(spark, texts).limit(0)).count() == 0


def test_cutting_stock_covers_demand_tightly():
    rng = np.random.default_rng(3)
    demand = {int(w): int(n) for w, n in zip(range(1, 129), rng.integers(0, 40, 128))}
    plan = packing.cutting_stock(demand, 128)
    for w, n in demand.items():
        assert sum(p.get(w, 0) * k for p, k in plan) >= n
    assert all(sum(w * c for w, c in p.items()) <= 128 for p, _ in plan)
    # No packing does with fewer: neither by area nor by pieces over one half.
    least = max(sum(w * n for w, n in demand.items()) / 128, sum(n for w, n in demand.items() if w > 64))
    assert sum(k for _, k in plan) <= 1.02 * least + 2


def test_chat_round_trip(spark):
    turns = [(1, 0, "system", None), (1, 1, "user", "hi <|im_end|> <\\|x"), (1, 1, "assistant", "a<|"), (1, 2, None, "x"),
             (2, 0, "assistant", "é́\n"), (2, None, "user", ""), (2, 5, "assistant", "b"), (2, 5, "assistant", "b"),
             (None, 0, "ro\nle\\n", "t"), (-1, 0, "user", ODD[15]), (-1, 1, "assistant", ODD[15])]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    for c in {t[0] for t in turns}:
        rows = sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        body = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
        loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
        assert got[c].n_turns == len(rows) and got[c].turns_sha256 == hashlib.sha256(body.encode()).hexdigest()
        assert got[c].loss_chars == len(loss) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    start, end = chat.Template(tokenizer_file("byte_bpe_50k.json")).reserved(load_tokenizer(tokenizer_file("byte_bpe_50k.json")))
    for r in chat.format_conversations(df).collect():
        assert r.ids[0] == start and r.ids[-1] == end and not {start, end} & set(r.ids[1:-1])
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def components_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)]
    got = {r.v: r.c for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components_of(links, {n for e in links for n in e})
    assert len(set(zip((want[v] for v in got), got.values()))) == len({want[v] for v in got}) == len(set(got.values()))


def test_rtree_loses_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(base, int(n), replace=False)) for n in rng.integers(200, 400, 150)]
    vectors = [count_vector(s) for s in sets]
    counts = np.stack([fold(v, 64) for v in vectors])
    sizes = np.array([s.size for s in sets])
    tree = CountRTree(counts, sizes)
    for i, s in enumerate(sets):
        found = set(tree.search(counts[i], s.size, 80).tolist())
        for j, t in enumerate(sets):
            if np.intersect1d(s, t).size >= needed(s.size, t.size, 80):
                assert j in found and may_link(vectors[i], s.size, vectors[j], t.size, 80)


def test_ngram_join_equals_brute_force(spark):
    rng = random.Random(11)
    texts = [*ODD, "a B c", "A b\tC", "a b c d"]
    for _ in range(12):  # families of near copies around the threshold, one of them crowded
        base = prose(rng, 80, 9999).split()
        for _ in range(rng.choice([2, 5, 70])):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = "edit%d" % rng.randrange(3)
            texts.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.linked_components(docs_of(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
             if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    want = components_of(links, range(len(texts)))
    assert got == {i: (len(s), want[i]) for i, s in enumerate(sets)}
    assert ngram_join.linked_components(docs_of(spark, texts).limit(0)).count() == 0


def test_quality_orders_three_grades(spark):
    rng = random.Random(3)
    kinds = [lambda: prose(rng, 40) + " ###" * 9, lambda: prose(rng, 40) + " insult", lambda: prose(rng, 40)]
    grades = [rng.randrange(3) for _ in range(900)]
    docs = docs_of(spark, [kinds[g]() for g in grades] + ODD)
    ratings = spark.createDataFrame([(i, g) for i, g in enumerate(grades[:600])] + [(3, None), (10**6, 1)], "doc_id long, grade int")
    model = quality_ordinal.train(docs, ratings)
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality_ordinal.grade_documents(docs, model).select("row.*", "expected_grade", "tail_probability").collect()
    held = [r for r in rows if 600 <= r.doc_id < 900]
    assert len(rows) == 900 + len(ODD)
    assert np.mean([(r.tail_probability >= 0.5) == (grades[r.doc_id] >= 1) for r in held]) > 0.93
    mean = [np.mean([r.expected_grade for r in held if grades[r.doc_id] == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    empty = quality_ordinal.train(docs, ratings.limit(0))
    assert {r.tail_probability for r in quality_ordinal.grade_documents(docs, empty).collect()} == {1.0}
    assert quality_ordinal.grade_documents(docs.limit(0), model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    toxic = [rng.random() < 0.15 for _ in range(1500)]
    docs = docs_of(spark, [prose(rng, 60, 4000) + (" " + rng.choice(["vileword", "vileterm"]) if t else "") for t in toxic] + ODD)
    labels = spark.createDataFrame([(i, int(t), 1) for i, t in enumerate(toxic)], "doc_id long, toxic int, quality int")
    model = toxicity_pu.train(docs, labels)
    rows = toxicity_pu.score_documents(docs, model).select("row.doc_id", "score").collect()
    held = [r for r in rows if r.doc_id < 1500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == toxic[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == 1500 + len(ODD)
    none = toxicity_pu.train(docs, labels.where("toxic = 0"))
    assert max(r.score for r in toxicity_pu.score_documents(docs, none).collect()) < 1e-9


def test_piece_lattice_equals_the_library(spark, texts):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    # Long texts, runs without a space, and one word of a megabyte.
    rng = random.Random(6)
    run = "".join(rng.choices("abcdeinorst", k=1 << 20))
    some = [*texts, "x" * 70 + " " + "ab" * 50, "don't ((( --- 😀", "日本語" * 3000, " " * 5000, "a " * 70_000, run]
    rows = piece_lattice.decode(piece_lattice.encode(docs_of(spark, some))).collect()
    assert len({r.row for r in rows}) == len(rows) == len(some)
    assert {r.doc_id: r.ids for r in rows} == {i: sp.encode(t or "") for i, t in enumerate(some)}
    assert {r.doc_id: r.text for r in rows} == {i: (t or "") for i, t in enumerate(some)}
    assert piece_lattice.encode(docs_of(spark, some).limit(0)).count() == 0


def test_piece_lattice_over_small_chunks(spark, texts, monkeypatch):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    monkeypatch.setattr(piece_lattice, "CHUNK", 100)
    some = [t for t in texts if t is None or len(t) < 4000] * 3
    df = docs_of(spark, some).repartition(5).select("text", "score", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id")).alias("doc_id"))
    rows = piece_lattice.encode(df).collect()
    want = [(i if i % 7 else None, sp.encode(t or "")) for i, t in enumerate(some)]
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in rows))) == sorted(map(repr, want))


def test_a_worker_keeps_its_packing_memo(texts):
    from qtrail.llm import packing
    path = tokenizer_file("word_bpe_49k.json")
    tok = pytest.importorskip("tokenizers").Tokenizer.from_file(path)
    for _ in range(2):  # the second time from the words kept
        memo = packing.word_encoder(path)
        got = [np.frombuffer(b, "<u4").tolist() for b in packing.encode_batch(memo, [t or "" for t in texts])]
        assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert packing.word_encoder(path) is memo


def test_word_ids_of_a_worker_are_bounded_and_exact(texts, monkeypatch):
    path = tokenizer_file("piece_bpe_32k.model")
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=path)
    monkeypatch.setattr(piece_lattice, "LATTICE_WORDS", 7)
    monkeypatch.setattr(piece_lattice, "MEMO_WORDS", 50)
    memo = piece_lattice.WordIds(piece_lattice.piece_table(path), piece_lattice.BPE)
    some = [*texts, "x" * 61 + "日本" * 40, "y" * 60, "ab" * 31, "é😀" * 45, None, ""]
    for at in range(0, len(some), 3):
        got = [np.frombuffer(b, np.int32).tolist() for b in memo.texts(some[at:at + 3])]
        assert got == [sp.encode(t or "") for t in some[at:at + 3]]
        assert len(memo.words) <= 50


def test_piece_lattice_moves_no_texts(spark):
    # One map: a dictionary of all words, joined back to the texts, took 3.8 x the input on disk.
    plan = piece_lattice.encode(docs_of(spark, ["a few words", None]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def best_by_hand(word, scores, unknown):
    """The best segmentation of all, ties to the longest last piece."""
    if not word:
        return 0.0, ()
    ways = []
    for s in range(len(word)):
        piece = word[s:]
        if piece in scores or len(piece) == 1:
            score, path = best_by_hand(word[:s], scores, unknown)
            ways.append((score + scores.get(piece, unknown), -s, path + (piece,)))
    return max(ways)[0], max(ways)[2]


def test_viterbi_fold_takes_the_best_path(spark):
    rng = random.Random(7)
    parts = sorted({"".join(rng.choices("abc", k=rng.randrange(1, 5))) for _ in range(25)} | {"▁", "▁a", "a"})
    table = [(i, f"<0x{i:02X}>", 0.0, True) for i in range(256)]
    table += [(256 + i, p, -rng.randrange(1, 40) / 4, False) for i, p in enumerate(parts)]
    scores = {p: s for _, p, s, byte in table if not byte}
    unknown, ids = min(scores.values()) - piece_lattice.UNKNOWN_COST, {p: i for i, p, _, byte in table if not byte}
    some = [" ".join("".join(rng.choices("abcé", k=rng.randrange(1, 9))) for _ in range(6)) for _ in range(20)]
    rows = piece_lattice.encode_with(docs_of(spark, some), table, piece_lattice.UNIGRAM).collect()
    longest = max(map(len, scores))

    def by_hand(text):
        out = []
        for word in piece_lattice._words(text, piece_lattice.re.compile(piece_lattice.word_pattern(table))):
            path = best_by_hand(word, scores, unknown)[1]
            assert piece_lattice.best_path_plainly(word, scores, longest, unknown) == list(path)
            out += [x for p in path for x in ([ids[p]] if p in ids else list(p.encode()))]
        return out

    assert {r.doc_id: r.ids for r in rows} == {i: by_hand(t) for i, t in enumerate(some)}
    long = "ab" * 400
    [r] = piece_lattice.encode_with(docs_of(spark, [long]), table, piece_lattice.UNIGRAM).collect()
    assert r.ids == [ids[p] for p in piece_lattice.best_path_plainly("▁" + long, scores, longest, unknown)]


def test_kind_of_a_model():
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        assert piece_lattice.model_kind(f.read()) == piece_lattice.BPE
    assert piece_lattice.model_kind(b"\x0a\x02\x0a\x00\x12\x04\x18\x02\x20\x05") == piece_lattice.BPE
    assert piece_lattice.model_kind(b"\x12\x02\x20\x05") == piece_lattice.UNIGRAM


@pytest.mark.parametrize("word", ["w w ", "a, b; c. ", "x! 12 "])
def test_long_texts_have_the_features_of_the_whole(word):
    text = ("Some (odd) words. " * 3 + word * (2 * features.SEGMENT // len(word) - 100)).encode()
    assert features.SEGMENT < len(text) < 2 * features.SEGMENT
    assert features._long(text, features.BITS).tolist() == next(features.features([text])).tolist()


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 16)).astype(np.float32)
    x[500:700] = x[500]  # copies
    rows = [(i, v.tolist(), "z") for i, v in enumerate(x)]
    rows += [(2000, None, ""), (2001, [0.0] * 16, ""), (2002, [1.0, None] + [0.0] * 14, ""), (2003, [float("nan")] * 16, ""),
             (2004, [1.0, 2.0], ""), (None, [1.0] * 16, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = ann.nearest(df, df.where("vec_id % 100 = 0")).collect()
    hits = total = 0
    for q in range(0, 1200, 100):
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(1200), d)) if i != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - d[r.vec_id]) < 1e-9 for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        hits, total = hits + len(set(best) & {r.vec_id for r in mine}), total + 10
    assert hits / total >= 0.9 and all(r.query_id < 1200 and r.vec_id < 1200 for r in got)
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id < 3")
    assert ann.nearest(few, few.where("vec_id = 0")).count() == 2


def test_repeated_query_rows(spark):
    x = np.random.default_rng(9).normal(size=(60, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(0, x[0].tolist()), (0, x[0].tolist()), (0, x[1].tolist())],
                                    "vec_id long, embedding array<double>")
    got = ann.nearest(df, queries).collect()
    assert sorted(r.rank for r in got) == sorted([*range(1, 11)] * 2)
    for v in (x[0], x[1]):
        d = np.sqrt(((x - v) ** 2).sum(1))
        mine = [r for r in got if abs(r.score - d[r.vec_id]) < 1e-9]
        assert sorted(r.rank for r in mine) == list(range(1, 11)) and len({r.vec_id for r in mine}) == 10
        assert 0 not in {r.vec_id for r in mine}


def test_spotsigs(spark):
    rng = random.Random(9)
    texts = ODD + [" ".join(rng.choice(["the", "of", f"w{rng.randrange(900)}"]) for _ in range(200)) for _ in range(30)]
    texts += [texts[-1], texts[-1] + " the tail end"]
    docs = docs_of(spark, texts)
    anchor = spotsigs.anchors(docs, count=2)
    assert set(anchor) == {"the", "of"}
    rows = spotsigs.edited(spotsigs.with_next(docs, anchor=anchor, per_bucket=3))
    rows = spotsigs.with_signatures(rows, {"after": "edited_text"}, anchor).select(
        "doc_id", "n_chars", "edited_text", "signatures", "after", spotsigs.likeness(rows["signatures"], rows["next_signatures"]).alias("near"))
    got = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(texts):
        t, following = t or "", texts[(i + 1) % len(texts)] or ""
        assert got[i].n_chars == len(t) and got[i].edited_text == t[:len(t) - len(t) // 4] + following[:len(t) // 4]
    n = len(texts)
    assert got[n - 2].signatures == got[n - 3].signatures and got[n - 3].near == 1.0 and got[n - 2].near > 0.9
    pairs, members = spotsigs.near_pairs(spotsigs.fingerprints(docs, anchor=anchor))
    assert (n - 3, n - 1) in {(r.a, r.b) for r in pairs.collect()} and members.count() == n
    assert spotsigs.with_next(docs.limit(0), anchor=anchor).count() == 0


def test_warc_round_trip(spark):
    big, rng = "x" * 1500, random.Random(1)
    pages = [(i, f"http://a/{i}é\"", prose(rng, 300)) for i in range(40)]
    pages += [(100, "u", big), (101, "u", big), (102, None, big), (103, "u", None), (104, "u", ""), (105, "u", "small"),
              (106, "u", "small"), (None, "u", "none")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc_zip.archive_round_trip(df).collect()}
    assert len(got) == len(pages)
    for p, u, h in pages:
        h = (h or "").encode()
        r = got[p]
        revisit = p in (100, 101)
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(h), hashlib.sha1(h).hexdigest(), u or "")
        assert (r.record_type, r.refers_to) == (("revisit", 102) if revisit else ("response", None))
        assert r.payload == (None if revisit else h)
    assert warc_zip.archive_round_trip(df.limit(0)).count() == 0


def test_zip64_directory():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(66_000):  # more entries than 16 bits count
            z.writestr(f"m{i}", b"%d" % i)
        z.comment = b"PK\x05\x06 comment"
    members = warc_zip.zip_members(out, len(out.getvalue()))
    assert len(members) == 66_000
    m = members[65_999]
    assert out.getvalue()[m.offset:m.offset + m.size] == b"65999"
    with pytest.raises(ValueError):
        warc_zip.zip_members(io.BytesIO(b"no archive"), 10)
    with pytest.raises(ValueError):
        warc_zip.parse_record(gzip.decompress(gzip.compress(b"HTTP")))
