"""The pipeline over planted documents, with nulls, repeated rows, clashing columns and empty tables."""

import random

import pytest

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _q_uid string, _Q_Spans int, uid string, kept boolean"


def prose(rng, n):
    return " ".join(f"w{rng.randrange(6000)}x" for _ in range(n))


def write(spark, folder, docs, labels=(), bench=()):
    rows = [(i, t, "en", "s", None if t is None else len(t), f"u{k}", k, None, True) for k, (i, t) in enumerate(docs)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def stages(spark, folder):
    """The rows after each stage but the last, and the result."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != "packing":
            assert after.columns == docs.columns
        out[name] = after.collect()
        docs = spark.createDataFrame(out[name], after.schema)
    return out


def test_every_stage_takes_what_was_planted_and_leaves_the_rest(spark, tmp_path):
    rng = random.Random(2)
    clean = [(i, prose(rng, rng.randrange(60, 150))) for i in range(40)]
    insults = ["idiot", "moron", "scum", "pathetic"]
    toxic = [(100 + i, f"{prose(rng, 30)} {insults[i % 4]} {prose(rng, 9)} {insults[(i + 1) % 4]} {prose(rng, 30)}") for i in range(30)]
    copies = [(200, clean[0][1]), (201, clean[1][1] + " end"), (None, clean[2][1] + " end"), (clean[3][0], clean[3][1])]
    none = [(300, None), (301, ""), (302, " "), (None, None), (None, prose(rng, 80))]
    none.append((None, none[-1][1] + " more"))
    passage, item = prose(rng, 70), prose(rng, 25)
    shared = [(400 + i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i in range(3)]
    leak = [(500, f"{prose(rng, 40)} {item} {prose(rng, 40)}")]
    docs = [*clean, *toxic, *copies, *none, *shared, *leak]
    labels = [(i, 1, 1) for i, _ in toxic[:20]] + [(i, 1, 0) for i, _ in clean] + [(None, None, None), (0, 1, None)]
    folder = write(spark, tmp_path, docs, labels, [(1, item), (2, None), (None, "nothing")])
    got = stages(spark, folder)
    ids = lambda rows: sorted((str(r["doc_id"]), str(r["text"])) for r in rows)
    pairs = lambda rows: sorted((str(i), str(t)) for i, t in rows)
    assert ids(got["toxicity"]) == pairs([*clean, *copies, *none, *shared, *leak])
    kept = got["near_dedup"]
    assert len(kept) == 40 + 5 + 3 + 1
    assert {r["doc_id"] for r in kept} >= {i for i, _ in [*clean, *shared, *leak]} | {300, 301, 302}
    assert sum(r["doc_id"] is None and r["text"] is not None for r in kept) == 1
    cut = {r["doc_id"]: r for r in got["substring_dedup"] if r["doc_id"] is not None}
    first, *rest = shared
    assert cut[first[0]]["text"] == first[1]
    for i, t in rest:
        assert cut[i]["text"].split() == t.split()[:40] + t.split()[110:] and cut[i]["n_chars"] == len(cut[i]["text"])
    assert all(cut[i]["text"] == t for i, t in [*clean, *leak])
    assert ids(got["decontamination"]) == sorted(x for x in ids(got["substring_dedup"]) if x[0] != "500")
    packed = got["packing"]
    assert len({(r["doc_id"], r["ids_crc32"]) for r in packed}) <= len(got["decontamination"]) == len(packed)
    result = corpus_pipeline.run(spark, folder).collect()
    drop = lambda rows: sorted((str(r["doc_id"]), r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert drop(result) == drop(packed)


@pytest.mark.parametrize("labelled", [False, True])
def test_without_labels_or_documents(spark, tmp_path, labelled):
    rng = random.Random(3)
    docs = [(i, prose(rng, 50)) for i in range(60)] if not labelled else []
    folder = write(spark, tmp_path, docs, [(1, 1, 1)] if labelled else [])
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() == len(docs)


def test_entry_registers_all(spark):
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in __spark_entry__.queries() and __spark_entry__.entry(spark).count() >= 0
