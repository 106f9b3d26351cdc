"""Search grammar, edit distance, facets, relational and spatial operators on small inputs; oracles at sf0.001."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions import markup
from quillspark.functions import display, scholarly
from quillspark.functions import text as t
from quillspark.operators import clusters, corpus as build, evaluation, facets, keywords, ordering, ranking, relational, search, semantic, sequence, spatial, vector_ops
from quillspark.sources import sinks
from quillspark.plans import catalog, corpus, measures, registry, resolve

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_parse():
    q = search.parse('alpha "beta gamma" -delta OR "one')
    assert [[(c.words, c.negated) for c in g] for g in q.groups] == [[(("alpha",), False), (("beta", "gamma"), False), (("delta",), True)], [(("one",), False)]]
    assert search.parse("OR").groups == []


@pytest.mark.parametrize("a,b,d", [("smtih", "smith", 1), ("ca", "abc", 3), ("abc", "abc", 0), ("", "ab", 2)])
def test_osa(a, b, d):
    assert search.osa(a, b, 3) == d


def test_search_negation_and_typos(spark):
    docs = spark.createDataFrame([(1, "the neural network"), (2, "nueral network fmri"), (3, "else"), (4, None)], "id long, text string")
    index = search.build_index(docs, "id", "text")
    found = {r["id"]: r["exactness"] for r in search.search(index, search.parse("neural network"))[0].collect()}
    assert found == {1: 2, 2: 1}
    ids, blocked = search.search(index, search.parse("network -fmri"))
    assert [r["id"] for r in ids.collect()] == [1] and [r["id"] for r in blocked.collect()] == [2]
    ids, blocked = search.search(index, search.parse("zzzz -fmri"))
    assert ids.isEmpty() and blocked.isEmpty()


def test_facets_exclude_themselves(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "f string, g string")
    got = {(r["facet"], r["value"]): r["n"] for r in facets.counts(rows, {"f": F.array("f"), "g": F.array("g")}, {"f": ["a"]}).collect()}
    assert got == {("f", "a"): 2, ("f", "b"): 1, ("g", "x"): 1, ("g", "y"): 1}


def test_quotas(spark):
    sizes = spark.createDataFrame([(0, 100), (1, 1), (2, 50)], "`group` int, n long")
    got = {r["group"]: r["quota"] for r in relational.quotas(sizes, 10).collect()}
    assert sum(got.values()) == 10 and min(got.values()) >= 1


def test_polygon_needs_three_corners(spark):
    rows = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    assert rows.where(spatial.in_polygon(F.col("x"), F.col("y"), [(0, 0), (1, 1)])).isEmpty()


def test_markdown():
    assert markup.convert(None) == "" and markup.convert(" a & b ") == "a & b"
    html = "<h2>A &amp; B</h2><p>One <b>two</b> <a href='u'>three</a> x<sup>2</sup></p><ol><li>a<ul><li>b</li></ul></li><li>c</li></ol>"
    assert markup.convert(html) == "A & B\n\nOne **two**[three](u) x^(2)\n\n1. a\n\n  - b\n\n2. c"
    assert markup.convert("<p>open <i>x") == "open _x"
    assert markup.convert("<div>a</div><div>b<br>c</div>") == "a\n\nb\nc"


def test_greedy_paths_by_walking(spark):
    rng = np.random.default_rng(3)
    rows = [(i % 3, i, rng.normal(size=4).tolist()) for i in range(40)] + [(0, None, [1.0] * 4), (1, 99, None)]
    got = sequence.greedy_paths(spark.createDataFrame(rows, "g int, id long, v array<double>"), "g", "id", "v").collect()
    for g in range(3):
        mine = {i: np.array(v) / np.linalg.norm(v) for h, i, v in rows if h == g and i is not None and v is not None}
        now, left, path = sum(mine.values()), dict(mine), []
        while left:
            best = max(left, key=lambda i: (left[i] @ now, -i))
            path.append(best)
            now = left.pop(best)
        assert path == [r["id"] for r in sorted((r for r in got if r["group"] == g), key=lambda r: r["place"])]
    with pytest.raises(ValueError):
        sequence.greedy_paths(spark.createDataFrame(rows, "g int, id long, v array<double>"), "g", "id", "v", most=5)


def test_kmeans_separates(spark):
    rows = [(i, [1.0, 0.01 * i, 0.0]) for i in range(10)] + [(100 + i, [0.0, 0.01 * i, 1.0]) for i in range(10)] + [(7, None)]
    got = clusters.fit(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 2).collect()
    assert len(got) == 20 and len({(r["cluster"], r["id"] < 100) for r in got}) == 2


def test_invariants_and_empty(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (None, 9), (2, None)], "k long, r long")
    parents = spark.createDataFrame([(1,), (None,)], "p long")
    assert tuple(ordering.invariants(rows, "k", parents, "p", "r").first()) == (4, 1, 1, 2)
    assert tuple(ordering.invariants(rows.limit(0), "k", parents, "p", "r").first()) == (0, 0, 0, 0)
    assert ordering.difference(rows, rows, "r").where("r is not null").isEmpty()


def test_accents_outside_any_list(spark):
    docs = spark.createDataFrame([(1, "Antonín Dvořák"), (2, "ŐSZI Şarkı źle"), (3, "dvora")], "id long, text string")
    index = search.build_index(docs, "id", "text")
    found = lambda q: {r["id"]: r["exactness"] for r in search.search(index, search.parse(q))[0].collect()}
    assert found("Dvořák") == {1: 1, 3: 0} and found('"antonin dvorak"') == {1: 2}
    assert found("oszi zle") == {2: 2} and found("sarkı") == {2: 1}
    assert t.fold_text("Ǘ ḱ") == spark.range(1).select(t.fold(F.lit("Ǘ ḱ"))).first()[0] == "u k"


def test_jvm_distance_equals_the_walk(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 7))) for _ in range(120)]
    pairs = [(a, b) for a in words[:40] for b in words]
    got = spark.createDataFrame(pairs, "word string, token string").selectExpr("word", "token", f"{search._OSA} AS d").collect()
    assert all(search.osa(r["word"], r["token"], 9) == r["d"] for r in got)


def test_search_by_brute_force(spark):
    """Random queries over random texts against evaluation in plain Python."""
    rng = np.random.default_rng(8)
    vocabulary = ["alpha", "aplha", "alphas", "beta", "bet", "gamma", "gamna", "delta", "tree", "three", "ab"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 7)))) for i in range(60)]
    index = search.build_index(spark.createDataFrame(docs, "id long, text string"), "id", "text")

    def near(word, token):
        return word == token or (search.threshold(word) > 0 and search.osa(word, token, search.threshold(word)) <= search.threshold(word))

    def clause(words, tokens):
        if len(words) == 1:
            hits = [t for t in tokens if near(words[0], t)]
            return int(words[0] in hits) if hits else None
        for s in range(len(tokens) - len(words) + 1):
            if all(near(w, x) for w, x in zip(words, tokens[s:])):
                return sum(w == x for w, x in zip(words, tokens[s:]))
        return None

    for text in ("alpha beta", '"tree delta" OR gamma', "three -alpha", "-alpha -beta", "bet OR beta -gamma", '-"ab tree" alphas'):
        query, want = search.parse(text), {}
        for i, body in docs:
            for g in query.groups:
                got = [(c, clause(c.words, body.split())) for c in g]
                if all((x is None) == c.negated for c, x in got):
                    want[i] = max(want.get(i, 0), sum(x for c, x in got if not c.negated))
        assert {r["id"]: r["exactness"] for r in search.search(index, query)[0].collect()} == want, text


def test_neighbours_in_many_blocks(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 5)).round(1)
    x[7] = x[8]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, v array<double>")
    got = vector_ops.neighbours(rows, "id", "v", 4, block=9).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    gap = np.round(np.maximum(1 - u @ u.T, 0), 9)
    for i in range(60):
        want = [j for j in np.lexsort((np.arange(60), gap[i])) if j != i][:4]
        assert want == [r["neighbour"] for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["rank"])]
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:20])], "g int, centroid array<double>")
    few, many = (sorted((r["id"], r["group"]) for r in vector_ops.nearest(rows, "id", "v", centres, "g", most=m).collect()) for m in (100, 5))
    assert few == many and len(few) == 60


def test_neighbours_do_not_multiply_rows(spark):
    """Each pass meets one block and carries the best along; copies, all measures, few rows to choose from and repeated blocks."""
    rng = np.random.default_rng(8)
    x = rng.integers(-2, 3, size=(40, 3)).astype(float)
    x[20:30] = x[3]
    x[(x == 0).all(1)] = 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    for measure, farthest, against in (("inner", False, None), ("euclidean", True, None), ("squared", False, "id < 4"), ("cosine", True, "id % 2 = 0")):
        near = vector_ops.neighbours(rows, "id", "v", 6, block=7, farthest=farthest, measure=measure, against=against and rows.where(against))
        assert "Generate" not in near._jdf.queryExecution().toString() and "CoGroup" not in near._jdf.queryExecution().toString()
        got = {(r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in near.collect()}
        y = vector_ops.unit_rows(x) if measure == "cosine" else x
        gap = np.round(vector_ops.gaps(y, y, measure), 9)
        others = [j for j in range(40) if against is None or (j < 4 if against == "id < 4" else j % 2 == 0)]
        want = {}
        for i in range(40):
            order = sorted((-gap[i, j] if farthest else gap[i, j], j) for j in others if against or j != i)[:6]
            want |= {(i, n + 1): (j, gap[i, j]) for n, (_, j) in enumerate(order)}
        assert got == want, measure


def test_semantic_scores_in_matrices(spark, monkeypatch):
    """Queries in several parts, ties, null vectors, and routes, against brute force; no row is paired with all queries in a plan."""
    monkeypatch.setattr(semantic, "KEPT", 40)
    rng = np.random.default_rng(9)
    q, v = rng.integers(-9, 10, size=(50, 4)), rng.normal(size=(12, 4))
    q[30:40] = q[2]
    rows = spark.createDataFrame([(i, i % 3, x.tolist()) for i, x in enumerate(q)] + [(90, 1, None), (91, None, [0, 0, 0, 0])], "id long, cluster int, q array<tinyint>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "query_id long, vector array<double>")
    found = semantic.search_all(asked, rows, 20.0, 7)
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()
    every = {i: {**{j: np.clip(v[i] @ q[j] * 20 / 127, -1, 1) for j in range(50)}, 90: 1.0, 91: 0.0} for i in range(12)}
    want = {(i, n + 1): j for i in range(12) for n, (_, j) in enumerate(sorted((-round(s, 9), j) for j, s in every[i].items())[:7])}
    assert {(r["query_id"], r["rank"]): r["id"] for r in found.collect()} == want
    centres = spark.createDataFrame([(c, q[c::3].mean(0).tolist()) for c in range(3)] + [(None, [9.0] * 4)], "cluster int, centroid array<double>")
    none = spark.createDataFrame([], "id long, neighbour long, distance double, rank int")
    got = semantic.routed(asked, rows, centres, none, 20.0, k=5, seeds=5, horizon=3.0)
    want = {(i, n + 1): j for i in range(12) for n, (_, j) in enumerate(sorted((-round(s, 9), j) for j, s in every[i].items() if j != 91)[:5])}
    assert {(r["query_id"], r["rank"]): r["id"] for r in got.collect()} == want


def test_silhouette_in_many_blocks(spark):
    rng = np.random.default_rng(7)
    rows = spark.createDataFrame([(i, rng.normal(size=3).tolist(), int(i % 4)) for i in range(50)] + [(60, [9.0, 9.0, 9.0], 9)], "id long, v array<double>, c int")
    assert np.isclose(*(vector_ops.silhouette(rows, "id", "v", "c", block=b).first()[0] for b in (7, 500)))
    assert vector_ops.silhouette(rows.where("c = 1"), "id", "v", "c").first()[0] is None
    assert all(np.isclose(*(list(f(rows, "c", "v", most=m).first())[k] for m in (2, 500))) for f in (clusters.separation, clusters.scatter) for k in (0, 1))


def test_expected_mutual_information_by_permutations():
    import itertools

    a, b = [0, 0, 0, 1, 1, 2], [0, 0, 1, 1, 2, 2]
    n = len(a)

    def mutual(x, y):
        return sum((k := sum(p == i and q == j for p, q in zip(x, y))) and k / n * np.log(n * k / (x.count(i) * list(y).count(j))) for i in set(x) for j in set(y))

    mean = np.mean([mutual(a, p) for p in itertools.permutations(b)])
    assert np.isclose(mean, sum(evaluation.expected_mutual_information(a.count(i), b.count(j), n) for i in set(a) for j in set(b)))


def test_older_grammar_and_registry():
    groups = ranking.parse('Alpha -"Beta  gamma" or "x"  -  OR -y')
    assert [(g.must, g.never) for g in groups] == [(["alpha"], ["beta  gamma"]), (["x"], []), ([], ["y"])]
    kinds = registry.Registry("kind")
    kinds.add("a", lambda x: x + 1)
    assert kinds.run("a", 1) == 2
    with pytest.raises(ValueError):
        kinds.add("a", len)
    with pytest.raises(KeyError):
        kinds.run("b")
    assert display.state_key({"b": {2, 1}, "a": (1, None)}) == display.state_key({"a": [1, None], "b": [1, 2]}) != display.state_key({})


def test_what_is_refused(spark):
    rows = spark.createDataFrame([(1, "Poster", "x1"), (2, "Withdrawn", "y"), (None, "Poster", "3")], "id long, decision string, poster string")
    with pytest.raises(Exception, match="no number"):
        build.accepted(rows, "id", "decision", "poster", rows.where("id = 9")).collect()
    assert [r["poster"] for r in build.accepted(rows.withColumn("poster", F.lit("007")), "id", "decision", "poster", rows.where("id = 9")).collect()] == [7]
    words = spark.createDataFrame([(["a", "z"], ["a", "b"])], "w array<string>, c array<string>")
    assert keywords.only_candidates(words, "w", "c").first()["kept"] == ["a"]
    with pytest.raises(Exception, match="no candidates"):
        keywords.only_candidates(words, "w", "c", strict=True).collect()
    with pytest.raises(Exception, match="unknown block"):
        spark.range(1).select(display.session_of(F.lit(7), F.lit(1), {0: (1, 2)})).collect()
    files = spark.createDataFrame([("a.csv", "1"), ("b.csv", "2")], "name string, sha256 string")
    with pytest.raises(Exception, match="not one file"):
        sinks.discover(files, {"x": "csv$"}).collect()
    assert semantic.worth_encoding("abc") and not semantic.worth_encoding("ab")


def test_text_of_markup_and_references(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(t.html_to_text(F.lit("<p>ref<sup>1,2</sup> H<SUB>2</SUB>O&nbsp;&amp; &eacute;</p><div>b</div>"))) == "ref¹,² H₂O & é\n\nb"
    assert one(t.html_to_text(F.lit(None).cast("string"))) == ""
    assert one(t.markdown_to_text(F.lit("# A\n- *b* `c` [d](e)\n2. f"))) == "A b c d f"
    assert list(one(t.title_changes(F.lit('  - “A  b”')))) == ["A b", ["trim_whitespace", "remove_leading_marker", "remove_wrapping_quotes", "normalize_spacing"]]
    assert one(t.clean_title(F.lit('"'))) == '"' and one(t.clean_title(F.lit(None).cast("string"))) == ""
    assert np.isclose(one(scholarly.title_similarity(F.lit("The Brain, A Map"), F.lit("the brain map"))), 2 * 13 / 28, atol=1e-5)
    assert one(scholarly.guessed_title(F.lit("Only one"))) == "Only one"
    assert one(scholarly.entries(F.lit("plain line"))) == ["plain line"] and one(scholarly.entries(F.lit(""))) == []
    assert one(t.keywords(F.lit("a, b ,,c"))) == ["a", "b", "c"]


def test_answers_and_cache(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "k long, prompt string")
    assert sorted(r["answer"] for r in registry.structured(rows, lambda batch: [p.upper() for p in batch]).collect()) == ["X", "Y"]
    cache = spark.createDataFrame([(1, "old")], "k long, value string")
    assert sorted(tuple(r) for r in registry.cached(rows, cache, "k", lambda d: d.withColumn("value", F.lit("new"))).collect()) == [(1, "old"), (2, "new")]
    shown = registry.Corpus("a", rows.withColumnRenamed("k", "id"), ("-id", "id")).found(spark.createDataFrame([(2,), (3,)], "id long"))
    assert [tuple(r) for r in shown.collect()] == [(2, -2, 2)]


def test_phrases_read_a_text_once(spark):
    assert str(keywords.phrases(F.col("text"))).count("regexp_extract_all") == 1
    got = spark.createDataFrame([("the red fox or dog",), (None,)], "text string").select(keywords.phrases(F.col("text"))).collect()
    assert [r[0] for r in got] == [["red", "fox", "dog", "red fox", "fox dog", "red fox dog"], []]


def _same_as_sql(spark, folder, name, table, schema, rows):
    """A query over one small table, written in the order given, against its SQL."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({registry.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_cut_entities(spark, tmp_path):
    pages = [(1, "u", "<p>A &amp; B&amp</p>&copy"), (2, "u", "&lt;b&gt; &amp;lt; &eacute;"), (3, "u", None)]
    _same_as_sql(spark, tmp_path, "q_html_text", "pages", "page_id long, url string, html string", pages)


def test_first_of_equal_lines(spark, tmp_path):
    lines = [(1, 5, 1, "R"), (1, 5, 1, "A"), (2, 4, 1, None), (2, 4, 2, "N"), (3, 1, None, "A"), (3, 2, 1, "R"), (4, 1, 1, None)]
    _same_as_sql(spark, tmp_path, "q_inverted_index", "lineitem", "l_partkey long, l_orderkey long, l_linenumber int, l_returnflag string", lines)


def test_letters_of_odd_signs(spark, tmp_path):
    signs = ["\u00df", "\u00a0a", "\u3000\u2003\u00e9", "\u0483a", "\u0903b", "\u017fx", "\u0131", "\ufb01", "\u212b", "\ta", "", " ", None]
    _same_as_sql(spark, tmp_path, "q_letters", "documents", "doc_id long, text string", list(enumerate(signs)))
    assert t.fold_text("a\u0483b\u0b94") == spark.range(1).select(t.fold(F.lit("a\u0483b\u0b94"))).first()[0] == "ab\u0b92"


def test_year_beside_the_title(spark, tmp_path):
    one = lambda x: spark.range(1).select(scholarly.year(F.lit(x))).first()[0]
    assert one("Doe J. The world in 1950. Press 2001. doi: 10.1234/x.1999") == 2001 and one("Maps of 1950") == 1950 and one("None") is None
    _same_as_sql(spark, tmp_path, "q_references", "documents", "doc_id long, n_chars long", [(1900, 29), (2019, 1), (7, 5), (123456, 30)])


def test_bounds_of_ascii_words(spark, tmp_path):
    texts = ["th\u00e9 \u00e9of", "\u00fcund\u00fc", "_the_ of", "bathe", "UND", "", None]
    _same_as_sql(spark, tmp_path, "q_tags", "conversations", "conv_id long, turn long, text string", [(i, 0, x) for i, x in enumerate(texts)])


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.execute(registry.ORACLE_SQL[name]).df()
    got = registry.QUERIES[name](spark, DIR).toPandas()
    assert sorted(got.columns) == sorted(want.columns)

    def rows(df):
        return sorted(tuple("-" if v is None or v != v else round(float(v), 9) if isinstance(v, (int, float)) else str(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))

    assert rows(got) == rows(want)
