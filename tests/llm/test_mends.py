"""Repeated and null keys, clashing names and hot spans in the training-data operators."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millwright.llm import alignment, bpe, licences, mixing, neardup, neighbours, queries, repeats
from millwright.session import spread

BASE = [f"w{i}" for i in range(60)]
A = " ".join(BASE)
B = " ".join(f"v{i}" for i in range(60))


def near(text):
    return text.replace("59", "other")


def parts(df):
    return sorted((r.doc_id, r.component_id, r.kept) for r in df.select("doc_id", "component_id", "kept").collect())


def test_every_text_of_a_repeated_key_links(spark):
    rows = [(1, A), (1, B), (5, near(B)), (6, near(A)), (7, "alone and by itself here")]
    found = parts(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == [(1, 1, True), (1, 1, True), (5, 1, False), (6, 1, False), (7, 7, True)]


def test_null_keys_link_like_others(spark):
    rows = [(None, A), (6, near(A)), (None, B), (None, near(B)), (9, None), (None, None)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in found)
    assert got == [
        ("6", "6", True), ("9", "9", True), ("None", "6", False), ("None", "None", True), ("None", "None", True), ("None", "None", True)
    ]


def test_every_vector_of_a_repeated_id_is_a_candidate(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.standard_normal(16)]) for i in rng.integers(0, 40, 300)]
    rows += [rows[0], (50, [1.0] * 16), (50, [-1.0] * 16), (50, [1.0] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    want = []
    for q, v in distinct:
        if q % 10:
            continue
        near_ones = []
        for c, w in distinct:
            if (c, w) != (q, v):
                x, y = np.array(v), np.array(w)
                near_ones.append((-float((x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum()))), c))
        want += [(q, rank + 1, c, round(-s, 9)) for rank, (s, c) in enumerate(sorted(near_ones)[:5])]
    got = [(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in neighbours.nearest(table, 10).collect()]
    assert sorted(got) == sorted(want)


def test_repeats_where_one_span_is_hot(spark, monkeypatch):
    """The same result however many parts a span is dealt to."""
    hot = "".join(f"<{i}>" for i in range(400))
    rows = [(i, f"{i} head {i * 7} " + hot + f" tail {i * 13}") for i in range(60)] + [(99, "x" * 900), (100, "lonely text " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    many = sorted(map(tuple, repeats.repeat_digests(docs).collect()))
    monkeypatch.setattr(repeats, "SPAN_PARTS", 1)
    assert sorted(map(tuple, repeats.repeat_digests(docs).collect())) == many
    texts = [(i, t.encode()) for i, t in rows]
    counts = {}
    for _, data in texts:
        for at in range(len(data) - 399):
            counts[data[at : at + 400]] = counts.get(data[at : at + 400], 0) + 1
    for key, data in texts:
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 399):
            if counts[data[at : at + 400]] > 1:
                gone[at : at + 400] = True
        assert next(r for r in many if r[0] == key)[2] == gone.sum()


@pytest.fixture(scope="module")
def clashing(spark, sf_dir):
    """Documents whose other columns bear the names that the stages use themselves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    for i, name in enumerate(("_row", "_tie", "_copy", "_copies", "_repeat_row", "_repeat_spans", "_score_before", "score", "row", "group", "_ROW_")):
        docs = docs.withColumn(name, F.lit(70 + i))
    return docs


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES][:-1])
def test_stages_keep_columns_of_any_name(spark, sf_dir, clashing, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    found = run(spark, clashing, sf_dir)
    assert found.columns == clashing.columns
    others = [c for c in clashing.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    rows = found.select(*others).distinct().collect()
    assert [tuple(r) for r in rows] == [tuple(range(70, 70 + len(others)))]
    assert run(spark, clashing.filter("false"), sf_dir).count() == 0


def test_tokens_of_an_empty_table(spark, sf_dir, clashing):
    assert corpus_pipeline.tokens(spark, clashing.filter("false"), sf_dir).count() == 0


def test_passages_of_over_fifty_words_go(spark, sf_dir):
    """Each stands in two documents that share nothing else."""
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("size(split(text, ' ')) > 50").limit(6).collect()
    assert len(passage) > 2
    rows = [(2 * i + j, f"only here {i} {j} " * 9 + p.text + f" and the end {i}{j}", "en", "s", 1) for i, p in enumerate(passage) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    left = {r.doc_id: r.text for r in corpus_pipeline.unrepeated(spark, docs, sf_dir).collect()}
    for i, p in enumerate(passage):
        middle = p.text[20:-20]
        assert middle not in left[2 * i] and middle not in left[2 * i + 1]
    assert all(t.startswith("only here") for t in left.values())


def test_leaves_of_the_mixture_are_sent_only_if_few(spark, sf_dir, monkeypatch):
    docs = queries.with_domain(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    run = lambda: sorted(map(str, mixing.chosen(docs, queries.PATH, queries.mix_weights(), 0.8, 2, 7).collect()))
    before = run()
    monkeypatch.setattr(mixing, "SENT_KEYS", 1)
    assert run() == before


@pytest.mark.parametrize("small", [0, 16_384])
@pytest.mark.parametrize("shape", ["path", "shuffled path", "star", "random", "trees", "none"])
def test_components_of_any_shape(spark, monkeypatch, shape, small):
    import random

    from millwright.llm import components as module
    from millwright.llm.components import components

    monkeypatch.setattr(module, "SMALL", small)
    rng = random.Random(7)
    n = 120
    names = list(range(n))
    if "shuffled" in shape:
        rng.shuffle(names)
    links = {
        "path": [(i, i + 1) for i in range(n - 1)], "star": [(n, i) for i in range(n)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(70)],
        "trees": [(i, i // 2) for i in range(2, 60)] + [(61, 62), (62, 62)], "none": [],
    }.get(shape.split()[-1])
    links = [(names[a] if a < n else a, names[b] if b < n else b) for a, b in links]
    head = {x: x for pair in links for x in pair if pair[0] != pair[1]}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((root(a), root(b)))
            head[b] = a
    rows = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(rows).collect()}
    assert got == {x: root(x) for x in head}


def test_token_files_of_any_size_and_their_documents(spark, sf_dir, monkeypatch):
    from millwright.llm import tokenfiles
    from millwright.session import fresh_path

    counts = {r.doc_id: r.n_tokens for r in queries.op6_token_counts(spark, sf_dir).collect()}
    want = {r.doc_id: r.n_tokens for r in queries.op10_byte_pairs(spark, sf_dir).collect()}
    assert counts == want
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_path(spark, "tokens")
    tokenfiles.write_token_files(docs.coalesce(2), queries.public_tokenizers.path("byte_bpe_50k.json"), folder)
    rows = lambda: sorted(map(tuple, tokenfiles.token_counts(spark, folder, block_tokens=100).collect()))
    before = rows()
    monkeypatch.setattr(tokenfiles, "WHOLE_BYTES", 1_000)
    monkeypatch.setattr(tokenfiles, "RANGE_BLOCKS", 3)
    assert rows() == before
    assert tokenfiles.document_places(docs.filter("false")).count() == 0


def held(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.fixture
def one_row_group(spark, tmp_path):
    """Many splits, of which one holds all rows."""
    path = str(tmp_path / "documents.parquet")
    texts = F.concat_ws(" ", F.lit("the apache license"), F.sha2(F.col("id").cast("string"), 512))
    spark.range(4000).select(F.col("id").alias("doc_id"), texts.alias("text"), F.lit("x").alias("_place")).coalesce(1).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield spark.read.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_of_one_row_group_are_dealt_over_the_cores(spark, one_row_group):
    docs = one_row_group
    assert docs.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and held(docs) == [4000]
    dealt = spread(docs)
    assert dealt.columns == docs.columns and sorted(dealt.collect()) == sorted(docs.collect())
    assert max(held(dealt)) < 1000
    # The scan of licences cuts its words in all of the parts.
    hits = licences.licence_hits(docs)
    assert max(held(hits)) < 1000 and hits.count() == 4000


def test_even_and_empty_inputs_are_not_dealt(spark):
    for even in (spark.range(0, 4000, 1, 16), spark.range(0)):
        assert spread(even) is even


def test_listed_characters_make_the_words_of_the_ranges(spark):
    texts = ["".join(f"{chr(c)}a{c}" for c in range(0x250)), "Ab9\u00e9\U0001f600z, \x7f\x80_-x", "", "[]^\\ \n\r\t\0"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    cut = lambda pattern: F.regexp_extract_all("text", F.lit(pattern), 0)
    for row in df.select(cut(licences.WORD).alias("ranges"), cut(licences.LISTED_WORD).alias("listed")).collect():
        assert row.ranges == row.listed


def test_alignment_keeps_no_merges_before_a_long_run():
    bpe.vocabulary.cache_clear()
    first = alignment.First(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode([" plain words " * 2000])
    assert bpe.vocabulary.cache_info().currsize == 0
    long = " " + "ab" * alignment.LONGEST_RUN
    assert b"".join(first.bytes_of[i] for i in first.one(long)) == long.encode()
    assert bpe.vocabulary.cache_info().currsize == 1


def test_alignment_writes_each_pair_once(spark, monkeypatch):
    names, keep = [], alignment.written
    monkeypatch.setattr(alignment, "written", lambda df, name: names.append(name) or keep(df, name))
    docs = spark.createDataFrame([(1, "a few plain words"), (2, "a few other words")], "doc_id long, text string")
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    assert alignment.align_tokenizers(docs, *paths).count() == 2
    assert names == ["alignments", "pair-counts"]
