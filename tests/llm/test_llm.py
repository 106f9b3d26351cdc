"""The ten operators against brute force, on small tables with nulls, empty texts, ties and repeated rows."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.llm import hmm_lm, text as tx
from quillspark.llm.substring_dedup import chain, common


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(5, 160)) for _ in range(60)]
    near = texts[0].split()
    near[3] = "changed"
    long = prose(rng, 300)
    texts += [texts[1], texts[1].upper(), " ".join(near), None, "", "one", "one", long, prose(rng, 40) + " " + " ".join(long.split()[50:130]) + " " + prose(rng, 30)]
    rows = [(i, t, "en", f"s{i % 3}", 7.0) for i, t in enumerate(texts)] + [(None, texts[2], None, None, 1.0), (5, texts[5], "en", "s1", 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double").repartition(3).cache()


def test_words_match_bytes_split():
    texts = ["Hello  WORLD\x0bé", "", None, "a\tb \x0c", "x" * 5000]
    h, at = tx.words(*tx.buffers(pa.array(texts)))
    assert np.diff(at).tolist() == [len((t or "").encode().split()) for t in texts]
    flat = [w for t in texts for w in (t or "").encode().lower().split()]
    assert len(set(h.tolist())) == len(set(flat))


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(0)
    model = hmm_lm.Model(np.float32([0.2, 0.8]), rng.dirichlet(np.ones(2), 2).astype("f4"), rng.dirichlet(np.ones(4), 2).T.astype("f4").copy())
    text = rng.integers(0, 4, 6)
    total = sum(model.start[p[0]] * model.emit[text[0], p[0]] * np.prod([model.move[p[i - 1], p[i]] * model.emit[text[i], p[i]] for i in range(1, 6)]) for p in itertools.product(range(2), repeat=6))
    tokens, active, _ = hmm_lm.time_major(text, np.array([0, 6]))
    assert np.isclose(np.log(hmm_lm.forward(model, tokens, active)[2].astype(float)).sum(), np.log(total), atol=1e-5)


def test_lm_base_score(docs):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = hmm_lm.score_texts(docs, held, ramp=((0.5, 2),), passes=2, count_table=50).collect()
    assert len(rows) == docs.count()
    count, texts = {}, [(r["doc_id"], r["text"]) for r in docs.collect()]
    split = lambda t: [*(t or "").encode().lower().split(), b""]
    for d, t in texts:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            for w in split(t):
                count[w] = count.get(w, 0) + 1
    n, kinds = sum(count.values()), len(count)
    want = sorted(round(sum(np.log10((count.get(w, 0) + 1) / (n + kinds + 1)) for w in split(t)), 6) for _, t in texts)
    assert want == sorted(round(r["base_score"], 6) for r in rows)
    assert all(r["train_tokens"] == n for r in rows)


def test_near_dedup_by_brute_force(docs):
    from quillspark.llm.near_dedup import link_documents

    rows = docs.where("doc_id is not null").select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = (r["text"] or "").encode().lower().split()
        sets.append(set(zip(w, w[1:], w[2:])) if len(w) > 2 else {tuple(w)} if w else set())
    low = {r["doc_id"]: r["doc_id"] for r in rows}
    for _ in rows:
        for (a, x), (b, y) in itertools.combinations(zip((r["doc_id"] for r in rows), sets), 2):
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                low[a] = low[b] = min(low[a], low[b])
    got = link_documents(docs, words=3, percent=85).where("doc_id is not null").collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(low.items())


def test_near_copies_without_ids_are_linked(spark):
    from quillspark.llm.near_dedup import link_documents

    rng = random.Random(8)
    text = prose(rng, 200)
    rows = [(None, text + " end"), (None, text), (9, prose(rng, 60))]
    got = link_documents(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [("9", "9", True), ("None", "None", True), ("None", "None", True)]
    named = [(4, text + " end"), (None, text), (3, text + " more"), (9, rows[2][1])]
    got = link_documents(spark.createDataFrame(named, "doc_id long, text string"), words=3, percent=85).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in got) == [("3", 3, True), ("4", 3, False), ("9", 9, True), ("None", 3, False)]


@pytest.mark.parametrize("name", ["op3_near_dedup", "op8_pivot_search"])
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_queries_equal_their_sql(spark, name, size):
    import duckdb

    from quillspark.llm.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{size}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = sorted(d[0] for d in want.description)
    want = {tuple(r) for r in want.df()[names].itertuples(index=False, name=None)}
    got = QUERIES[name](spark, f"/root/testdata/{size}")
    assert sorted(got.columns) == names
    assert {tuple(r) for r in got.toPandas()[names].itertuples(index=False, name=None)} == want


def test_sharding_is_even_and_whole(docs):
    from quillspark.llm.kd_shard import shard

    got = shard(docs, depth=2, grain=1.0).collect()
    assert len(got) == docs.count()
    for s in {r["shard"] for r in got}:
        mine = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(mine) == list(range(len(mine)))
    assert all(len({r["shard"] for r in got if r["text_crc32"] == c}) == 1 for c in {r["text_crc32"] for r in got} - {0})


def test_chain_and_subsequence():
    assert chain([(0, 10, 0, 10), (12, 20, 13, 21), (5, 9, 90, 94)])[0][:4] == (0, 20, 0, 21)
    assert common([1, 2, 3, 4], [2, 9, 4]) == 2
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(40))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common(a, b) == common(a, b, wide=7) == table[-1][-1]


def test_substring_and_leaks(docs, spark):
    from quillspark.llm.lsa_decontam import contaminated
    from quillspark.llm.substring_dedup import repeated_passages

    got = repeated_passages(docs).collect()
    assert any((r["doc_id"], r["partner_id"]) == (68, 67) and r["doc_end"] - r["doc_start"] >= 78 for r in got)
    item = " ".join(docs.where("doc_id = 7").first()["text"].split()[1:30])
    bench = spark.createDataFrame([(1, item), (2, None), (3, "tiny"), (4, "nothing of this kind is in any text at all here")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()} == ({(7, 1)} if len(item.split()) >= 8 else set())


def covered(passages, doc):
    """The words of a document that its passages hold."""
    return {i for r in passages if r["doc_id"] == doc for i in range(r["doc_start"], r["doc_end"])}


def test_passages_around_differing_words(spark):
    from quillspark.llm.substring_dedup import repeated_passages

    rng = random.Random(11)
    rows = []
    for n, (size, gap) in enumerate([(60, 31), (60, 45), (60, 100), (200, 120), (200, 300)]):
        head, foot = prose(rng, size, 9000), prose(rng, size, 9000)
        rows += [(100 * n + i, f"{prose(rng, 20, 9000)} {head} {prose(rng, gap, 9000)} {foot} {prose(rng, 20, 9000)}") for i in (1, 2)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for n, (size, gap) in enumerate([(60, 31), (60, 45), (60, 100), (200, 120), (200, 300)]):
        want = set(range(20, 20 + size)) | set(range(20 + size + gap, 20 + 2 * size + gap))
        assert covered(got, 100 * n + 2) == want
        assert covered(got, 100 * n + 1) == set()
    assert all(r["identity"] >= 0.8 for r in got)


def test_passage_whose_halves_stand_elsewhere(spark):
    from quillspark.llm.substring_dedup import repeated_passages

    rng = random.Random(12)
    words = lambda n: prose(rng, n, 9000)
    rows = []
    for n in range(8):
        left, right = words(30), words(30)
        for i, middle in enumerate([left, right, f"{left} {right}", f"{left} {right}"]):
            rows.append((10 * n + i, f"{words(30)} {middle} {words(30)}"))
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(covered(got, 10 * n + 3) >= set(range(30, 90)) for n in range(8))
    assert not any(covered(got, 10 * n + i) for n in range(8) for i in (0, 1))


def test_every_copy_in_a_document_is_found(spark):
    from quillspark.llm.substring_dedup import repeated_passages

    rng = random.Random(13)
    words = lambda n: prose(rng, n, 9000)
    first, second = words(60), words(60)
    quote = " ".join(second.split()[:40])
    rows = [
        (1, f"{words(20)} {first} {words(20)}"),
        (2, f"{words(20)} {first} {words(40)} {first} {words(20)}"),
        (3, f"{words(20)} {second} {words(20)}"),
        (4, f"{words(20)} {quote} {words(40)} {second} {words(20)}"),
    ]
    for tasks in (1, 4):
        got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)).collect()
        assert covered(got, 2) == set(range(20, 80)) | set(range(120, 180))
        assert covered(got, 4) == set(range(100, 160))
        assert covered(got, 1) == covered(got, 3) == set()


def test_passage_that_repeats_itself_is_one_span(spark):
    from quillspark.llm.substring_dedup import repeated_passages

    rng = random.Random(14)
    words = lambda n: prose(rng, n, 9000)
    rows = [(i, f"{words(20)} {' '.join(['du'] * 80)} {words(20)}") for i in (1, 2)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["doc_start"], r["doc_end"], r["partner_id"]) for r in got] == [(2, 20, 100, 1)]


def test_search_by_brute_force(spark):
    from quillspark.llm.pivot_search import search

    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)] + [(7, [0.5] * 8), (None, [1.0] * 8), (300, None), (301, [float("nan")] * 8), (302, [1.0])]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5, pivots=6).collect()
    x = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and i < 300]
    want = {(i, r + 1, j, s) for i, q in x if i % 20 == 0 for r, (s, j) in enumerate(sorted(((int(q @ y), j) for j, y in x if j != i), key=lambda p: (-p[0], p[1]))[:5])}
    assert {tuple(r) for r in got} == want


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    from quillspark.llm.packing import pack

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    got = pack(docs, path, capacity=64).collect()
    tok = Tokenizer.from_file(path)
    want = []
    for r in docs.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want += [(str(r["doc_id"]), i // 64, i, len(ids[i : i + 64]), zlib.crc32(np.array(ids[i : i + 64], "<u4").tobytes())) for i in range(0, len(ids), 64)]
    assert sorted(want) == sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    for s in {r["sequence_id"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64


def test_empty_tables(docs, spark):
    from quillspark.llm import kd_shard, language_id, near_dedup, quality_gbt, toxicity

    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert near_dedup.link_documents(none).isEmpty() and kd_shard.shard(none).isEmpty()
    assert language_id.identify(none, F.lit(False)).isEmpty()
    assert {r["score"] for r in quality_gbt.score_quality(docs, labels, F.lit(False)).collect()} == {0.5}
    assert {round(r["score"], 6) for r in toxicity.score_toxicity(docs, labels, F.lit(False)).collect()} == {0.05}
    mixed = docs.limit(0).union(spark.createDataFrame([(1, "You STUPID pathetic clown!", "en", "s", 1.0), (2, None, None, None, None), (3, "a fine day", "en", "s", 1.0)], docs.schema))
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score_toxicity(mixed, labels, F.lit(False)).collect()} == {1: 1, 2: 0, 3: 0}


def test_search_keeps_huge_components(spark):
    from quillspark.llm.pivot_search import search

    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100, [4e7, 1.0, 0.0, 0.0]), (101, [-3e9, 2.0, 1.0, 5.5]), (120, [5e17, -1.25, 1.0, 1.0]), (121, [1e300, 1.0, 1.0, 1.0])]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=7, pivots=3).collect()
    x = [(i, [int(math.floor(64 * c)) for c in v]) for i, v in rows]
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(p * q for p, q in zip(a, b))))
    want = {(i, r + 1, j, s) for i, q in x if i % 20 == 0 for r, (s, j) in enumerate(sorted(((dot(q, y), j) for j, y in x if j != i), key=lambda p: (-p[0], p[1]))[:7])}
    assert {tuple(r) for r in got} == want


def test_randomised_svd_equals_numpy():
    from quillspark.llm.lsa_decontam import randomised_svd

    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 40)) @ np.diag(0.8 ** np.arange(40)) @ np.linalg.qr(rng.normal(size=(40, 40)))[0]
    vectors, values = randomised_svd(lambda b: x.T @ (x @ b), 40, 6)
    _, want, turned = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, want[:6], rtol=1e-3)
    assert np.allclose(np.abs((vectors * turned[:6].T).sum(0)), 1, atol=1e-2)
    assert np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-6)


def zipf(rng, n, words=3000):
    return [f"w{int(words ** rng.random()) - 1}x" for _ in range(n)]


def edited(rng, words, share):
    """words with a share of them, rounded, replaced by others."""
    out = list(words)
    for i in rng.sample(range(len(out)), round(share * len(out))):
        out[i] = f"e{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("least,most", [(9, 12), (20, 40), (90, 300)])
def test_paraphrases_of_benchmark_items_are_found(spark, least, most):
    from quillspark.llm.lsa_decontam import contaminated

    rng = random.Random(least)
    items = [(i, zipf(rng, rng.randrange(least, most + 1))) for i in range(100)]
    docs = [(1000 + i, " ".join(zipf(rng, rng.randrange(20, 200)))) for i in range(300)]
    docs += [(i, " ".join(zipf(rng, rng.randrange(10, 120)) + edited(rng, w, 0.2) + zipf(rng, rng.randrange(10, 120)))) for i, w in items]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert len(got & {(i, i) for i, _ in items}) >= 90
    assert len({d for d, i in got if d != i}) <= 3


def test_short_items_are_matched_word_for_word(spark):
    from quillspark.llm.lsa_decontam import contaminated

    rows = [(1, "x Alpha beta  gamma delta epsilon zeta y"), (2, "alpha beta gamma delta x epsilon zeta"), (3, "Tiny"), (4, "a tiny thing"), (5, None), (None, "so alpha beta gamma it is"), (7, "alpha beta gamma alpha beta gamma")]
    bench = [(1, "alpha beta gamma delta epsilon zeta"), (2, "tiny"), (3, "alpha beta gamma"), (4, ""), (5, None), (6, "alpha BETA gamma")]
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["start"], r["end"]) for r in found) == sorted([("1", 1, 1, 7), ("3", 2, 0, 1)] + [(d, i, s, s + 3) for d, s in (("1", 1), ("2", 0), ("None", 1), ("7", 0)) for i in (3, 6)])


def test_lm_expected_counts_by_enumeration():
    rng = np.random.default_rng(1)
    model = hmm_lm.Model(np.float32([0.3, 0.7]), rng.dirichlet(np.ones(2), 2).astype("f4"), rng.dirichlet(np.ones(3), 2).T.astype("f4").copy())
    texts = [rng.integers(0, 3, n) for n in (5, 1, 3)]
    starts, moves, emits, likelihood = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2)), 0.0
    for t in texts:
        paths = list(itertools.product(range(2), repeat=len(t)))
        p = np.array([model.start[z[0]] * model.emit[t[0], z[0]] * np.prod([model.move[z[i - 1], z[i]] * model.emit[t[i], z[i]] for i in range(1, len(t))]) for z in paths])
        likelihood += np.log10(p.sum())
        for z, w in zip(paths, p / p.sum()):
            starts[z[0]] += w
            for i, s in enumerate(z):
                emits[t[i], s] += w
                if i:
                    moves[z[i - 1], s] += w
    tokens, active, _ = hmm_lm.time_major(np.concatenate(texts), np.cumsum([0, *(len(t) for t in texts)]))
    got = hmm_lm.expected(model, tokens, active)
    assert np.allclose(got[0], starts, atol=1e-4) and np.allclose(got[1], moves, atol=1e-4) and np.allclose(got[2], emits, atol=1e-4)
    assert np.isclose(got[3], likelihood, atol=1e-4)


def test_lm_passes_raise_the_likelihood_and_beat_the_base(spark):
    rng = random.Random(6)
    # two kinds of texts whose words alternate between classes
    line = lambda kind: " ".join(f"{'ab' if i % 2 else 'cd'}{kind}{rng.randrange(30)}" for i in range(40))
    docs = spark.createDataFrame([(i, line(i % 2)) for i in range(200)], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    sums = []
    for passes in (1, 3, 6):
        rows = hmm_lm.score_texts(docs, held, states=4, ramp=((0.5, 2),), passes=passes, gain=-1.0).collect()
        sums.append(sum(r["score"] for r in rows if not r["held_out"]))
    assert sums == sorted(sums)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.9 * sum(r["base_score"] for r in out)
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_score_by_brute_force(spark):
    """The score of a text is the forward probability times each rare word's share of the rare symbol, by its count."""
    texts = ["a b a c", "a a b", "b a d e", "", None, "a f b a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = hmm_lm.score_texts(docs, F.lit(False), states=1, symbols=2, ramp=(), passes=1, count_table=3).collect()
    tokens = [[*(t or "").split(), None] for t in texts]
    count = {w: sum(t.count(w) for t in tokens) for w in {w for t in tokens for w in t}}
    total, distinct = sum(count.values()), len(count)
    top = sorted(count.values(), reverse=True)[:2]
    assert {r["train_tokens"] for r in rows} == {total}
    # one state: its emissions are the smoothed unigram law
    mine = [w for w in count if count[w] in top][:2] if sorted(count.values())[-3] < top[1] else None
    assert mine is not None
    rare = total - sum(top)
    prior = {w: (count[w] + 1) / (total + distinct + 1) for w in mine}
    other = (rare + distinct - 2 + 1) / (total + distinct + 1)
    law = {w: (count[w] + 50 * prior[w]) / (total + 50) for w in mine}
    spare = (rare + 50 * other) / (total + 50)
    for r in rows:
        want = sum(np.log10(law[w]) if w in law else np.log10(spare) + np.log10((count[w] + 1) / (rare + distinct - 2 + 1)) for w in tokens[r["doc_id"]])
        assert np.isclose(r["score"], want, atol=1e-4)


def test_language_held_out_accuracy(spark):
    from quillspark.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out and lang_pred != 'und'").collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.97


def test_language_knows_many_values_and_repeats(spark):
    from quillspark.llm.language_id import identify

    rng = random.Random(9)
    letters = [f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "aeiou"]
    docs = [(None if i % 3 else i, " ".join(rng.choice(letters[2 * k : 2 * k + 2]) * 2 for _ in range(30)), f"l{k:02}") for k in range(40) for i in range(6)]
    docs += [(1, "fafa fafa fafa", "l05")] * 200 + [(2, None, "l00"), (3, "123 !", "l00"), (4, "", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = identify(frame, F.lit(False)).toPandas()
    assert len(got) == len(docs)
    assert len(set(got["lang_pred"]) - {"und"}) >= 38
    assert (got["lang_pred"] == "und").sum() == 3
    again = identify(frame.repartition(7), F.lit(False)).toPandas()
    assert sorted(map(str, got.itertuples(index=False))) == sorted(map(str, again.itertuples(index=False)))


def test_quality_held_out_accuracy(spark):
    from quillspark.llm.queries import QUERIES

    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("y"))
    rows = QUERIES["op2_quality_gbt"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert np.mean([r["y"] == r["predicted"] for r in rows]) >= 0.98


def test_toxicity_held_out_recall(spark):
    from quillspark.llm.queries import QUERIES

    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    rows = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    caught = sum(r["y"] and r["predicted"] for r in rows)
    assert caught >= 0.9 * sum(r["y"] for r in rows)
    assert caught >= 0.95 * sum(r["predicted"] for r in rows)


def test_label_model_finds_accuracies_and_copied_voters():
    from quillspark.llm.toxicity import label_model

    rng = np.random.default_rng(4)
    y = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, y, ~y).astype(np.int8)
    good = [vote(0.9), vote(0.8), vote(0.85)]
    weak = vote(0.6)
    copies = [np.where(rng.random(4000) < 0.95, weak, 1 - weak).astype(np.int8) for _ in range(4)]
    wrong = rng.random(4000) < 0.1
    post, right, parent = label_model(np.column_stack([*good, weak, *copies]), 0.3, (y ^ wrong).astype(float))
    assert ((post >= 0.5) == y).mean() > 0.9
    toxic = [(v[v == 1] == y[v == 1]).mean() for v in good]
    clean = [(v[v == 0] == y[v == 0]).mean() for v in good]
    assert all(min(abs(r - a), abs(r - b)) < 0.08 for r, a, b in zip(right, toxic, clean))
    assert all(parent[j] >= 3 or j == 3 for j in range(3, 8) if parent[j] >= 0) and (parent[3:] >= 3).sum() >= 4


def test_shards_have_equal_bytes(spark):
    from quillspark.llm.queries import QUERIES

    rows = QUERIES["op5_kd_shard"](spark, "/root/testdata/sf0.01").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 for r in rows)
    total = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(16)]
    heaviest = max(sum(r["size"] for r in rows if r["text_crc32"] == c) for c in {r["text_crc32"] for r in rows})
    assert max(total) - min(total) <= 2 * max(heaviest, max(r["size"] for r in rows))
    assert max(total) <= 1.1 * sum(total) / 16 + max(r["size"] for r in rows)
    for s in range(16):
        slots = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))


def sharded(spark, rows, **how):
    from quillspark.llm.kd_shard import shard

    got = shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size string, shard int"), **how).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    return sizes


def test_repeated_rows_and_heavy_groups_are_dealt(spark):
    rng = random.Random(3)
    rows = [(7, "the same text", "en", "s", None, 5)] * 400 + [(i, prose(rng, 3), "en", "s", "x", 1) for i in range(400)]
    sizes = sharded(spark, rows)
    assert len(sizes) == 16 and max(sizes.values()) <= 1.15 * sum(sizes.values()) / 16
    # a heavy text that can't be split stands alone, wherever it lies in the order
    heavy = [(i, "x" * 8000 if i == at else "ab", "en", "s", None, 1) for at in (0, 5, 9) for i in range(10)]
    for at in range(3):
        sizes = sharded(spark, heavy[10 * at : 10 * at + 10], depth=1)
        assert sorted(sizes.values()) == [27, 8001]
    few = [(i, t, None, None, None, None) for i, t in enumerate([None, None, "", "", " ", " ", "\t", "\t", None])]
    assert max(sharded(spark, few, depth=2).values()) <= 8


def test_sharding_to_a_target(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(1, 30)), "en", f"s{i % 5}", None, 1) for i in range(300)]
    sizes = sharded(spark, rows, target_bytes=2500)
    assert sorted(sizes) == list(range(len(sizes))) and max(sizes.values()) <= 2500
    assert min(sizes.values()) >= 900


def test_passages_do_not_depend_on_the_layout(spark):
    from quillspark.llm.substring_dedup import repeated_passages

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.union(docs.where("doc_id % 50 = 0")).cache()  # some rows repeat
    first, second = (sorted(map(tuple, repeated_passages(docs.repartition(n)).collect())) for n in (2, 9))
    assert len(first) > 50 and first == second


def test_edited_passages_are_found(spark):
    from quillspark.llm.substring_dedup import common, repeated_passages

    rng = random.Random(21)
    rows, where = [], {}
    for n in range(120):
        passage = zipf(rng, 80, 5000)
        other = [f"e{rng.randrange(10**6)}" if rng.random() < 0.08 else w for w in passage]
        at = rng.randrange(10, 60)
        rows += [(2 * n, " ".join(zipf(rng, 40, 5000) + passage + zipf(rng, 30, 5000))), (2 * n + 1, " ".join(zipf(rng, at, 5000) + other + zipf(rng, 30, 5000)))]
        where[2 * n + 1] = at
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = [len(covered(got, d) & set(range(at, at + 80))) for d, at in where.items()]
    assert sum(h >= 50 for h in hit) >= 0.9 * len(hit)
    words = {d: t.split() for d, t in rows}
    for r in got:  # what is reported is alike by brute force
        x, y = words[r["doc_id"]][r["doc_start"] : r["doc_end"]], words[r["partner_id"]][r["partner_start"] : r["partner_end"]]
        assert r["matched"] <= common(x, y) and r["matched"] >= 0.8 * max(len(x), len(y)) - 1e-9
        assert abs(r["identity"] - r["matched"] / max(len(x), len(y))) < 1e-9


def test_a_passage_of_very_many_documents(spark, monkeypatch):
    from quillspark.llm import substring_dedup as sd

    monkeypatch.setattr(sd, "SHARED", 7)
    monkeypatch.setattr(sd, "ASKED", 5)
    rng = random.Random(22)
    passage = " ".join(prose(rng, 70, 9000).split())
    rows = [(i, f"{prose(rng, 3 + i % 20, 9000)} {passage} {prose(rng, 20, 9000)}") for i in range(60)]
    got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert all(covered(got, i) == set(range(3 + i % 20, 73 + i % 20)) for i in range(1, 60)) and not covered(got, 0)
    assert {r["doc_id"] for r in got if r["partner_id"] == 0} == set(range(1, 60))


def test_near_dedup_in_buckets_of_alike_texts(spark, monkeypatch):
    """Texts that share half of their words meet in buckets without links; some of them are near copies."""
    from quillspark.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(31)
    shared = prose(rng, 120, 9000)
    texts = [f"{shared} {prose(rng, rng.randrange(20, 90), 9000)}" for _ in range(90)]
    texts += [f"{t} {prose(rng, rng.randrange(1, 16), 9000)}" for t in texts[:40]]
    sets = []
    for t in texts:
        w = t.split()
        sets.append(set(zip(w, w[1:], w[2:])))
    low = list(range(len(texts)))
    for _ in range(4):
        for a, b in itertools.combinations(range(len(texts)), 2):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low[a] = low[b] = min(low[a], low[b])
    got = near_dedup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), words=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(low))
    assert 20 < sum(a != b for a, b in enumerate(low)) < 90


def test_packing_of_odd_texts_and_its_bound(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from quillspark.llm.packing import pack

    rng = random.Random(41)
    odd = ["é ü ñ ß Ünïcödé", "a\u00a0b\u2003c\u3000d\u200be", "<|endoftext|> <|x", "<s> </s> [PAD] \x00\x01\x1f\x7f", "x" * 9000, "日本語のテキスト " * 40, "🙂👩‍👩‍👧 " * 30, "tab\t\tnew\n\n\r\nline", "  lead and trail  ", "1234567890 3.14 1e-9", "a" + "\u0301" * 50, "ﬁ ﬂ Ⅷ ½", "\ufeffbom", "don't I'LL we've", None, "", " ", "\n"]
    texts = odd + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), rng.randrange(0x400, 0x4FF), rng.randrange(0x2000, 0x2070)])) for _ in range(200)) for _ in range(20)] + [prose(rng, rng.randrange(1, 400)) for _ in range(150)]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    got = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), path, capacity=512).collect()
    tok = Tokenizer.from_file(path)
    want, total = [], 0
    for i, text in enumerate(texts):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        want += [(i, k // 512, k, len(ids[k : k + 512]), zlib.crc32(np.array(ids[k : k + 512], "<u4").tobytes())) for k in range(0, len(ids), 512)]
    assert sorted(want) == sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    used = {}
    for r in got:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 512 and len(used) <= -(-total // 512) * 1.1 + 3


def test_the_scan_for_seeds_is_frugal_and_sends_each_place_once():
    """Half a million seeds, 14 MB, are linked in less than four times their size; what is sent is as by brute force."""
    import tracemalloc

    from quillspark.llm import substring_dedup as sd

    def batch(texts):
        return pa.record_batch([pa.array(np.arange(len(texts))), pa.array(np.arange(len(texts)) * 7), pa.array(texts)], names=["doc_id", "uid", "text"])

    def scanned(texts, buckets):
        return sd._scan(6, 6, buckets)(batch(texts[i : i + 500]) for i in range(0, len(texts), 500))

    rng = np.random.default_rng(6)
    texts = [" ".join(map(str, rng.integers(0, 9000, 400))) for _ in range(4000)]
    list(scanned(texts[:1], 408))  # what is made once
    tracemalloc.start()
    rows = sum(r.num_rows for r in scanned(texts, 408))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= 408 and peak < 56e6

    few = [texts[0], " ".join(texts[1].split()[:90]), f"{texts[2]} {texts[0]}", texts[0], f"{texts[1]} {texts[1]}"]
    want, got, links, sent = {}, {}, set(), set()
    for i, t in enumerate(few):
        data = np.frombuffer(t.encode(), np.uint8)
        h, at = tx.words(data, np.array([0, len(data)]))
        for p, v in zip(*(x.tolist() for x in sd.seeds(h, at, 6, 6))):
            want.setdefault(v, {}).setdefault(i, []).append(p)
    for v, at in want.items():
        first = min(at)
        got[v] = (first, at[first])
        links |= {(v, i * 7, p, n, first, at[first][n % len(at[first])]) for i in at if i != first for n, p in enumerate(at[i])}
    held, seen = {}, []
    for r in (r for b in scanned(few, 32) for r in b.to_pylist()):
        if r["seed"] is None:
            seen.append(r["bucket"])
            for v, i, p in zip(*(np.frombuffer(r[c], t).tolist() for c, t in (("h", np.uint64), ("doc", np.int64), ("places", np.int32)))):
                assert v % 32 == r["bucket"]
                held.setdefault(v, (i, []))[1].append(p)
        else:
            sent.add((r["seed"] % 2**64, r["uid"], r["pos"], r["number"], r["partner_id"], r["partner_pos"]))
    assert held == got and sent == links and len(seen) == len(set(seen))


def test_passages_are_cut_once(spark):
    """One call cuts a text; another for the filter behind it would take workers of its own."""
    import contextlib
    import io

    from quillspark.llm.substring_dedup import uid_of, without_passages

    docs = spark.createDataFrame([(1, "a b c", 5), (2, "d e", 3), (3, "f g", 3)], "doc_id long, text string, n_chars long")
    passages = docs.where("doc_id < 3").select("doc_id", uid_of().alias("uid"), F.lit(0).alias("doc_start"), F.lit(2).alias("doc_end"))
    got = without_passages(docs, passages)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        got.explain()
    assert plan.getvalue().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, got.collect())) == [(1, "c", 1), (3, "f g", 3)]


def test_release_collects_the_heap(spark):
    from quillspark.llm.store import release

    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    release(spark)
    assert full() > before
