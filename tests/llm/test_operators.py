"""The training-data operators against plain definitions, and on awkward rows."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millwright.llm import fingerprints, licences, mixing, neardup, neighbours, quality, queries, repeats, tokenfiles, toxicity
from millwright.llm.bpe import encode_digests
from millwright.llm.components import components
from millwright.session import fresh_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(20_000))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    (1, "Released under the MIT License. MIT license, GNU General Public License", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, LONG, "en", "a"),
    (5, LONG.replace("word7 ", "other ", 3), "en", "b"),
    (6, "too short", "de", "b"),
    (6, "too short", "de", "b"),
    (7, "too  SHORT", "de", "b"),
    (8, "<|endoftext|> é ü 漢字   x  \n\n y", "fr", None),
    (None, "no key at all but some words", "es", "c"),
    (9, "CC BY-NC 4.0 K cc  by", "es", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, and columns whose names clash with results."""
    rows = [(*r, 1.5, "x", "y", 3) for r in ROWS]
    schema = "doc_id long, text string, lang string, source string, score double, spans string, component string, n_tokens int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_every_operator_takes_awkward_and_empty_tables(odd, none, labels):
    for run in (
        licences.scan_licences,
        lambda d: quality.quality_scores(d, labels),
        fingerprints.document_fingerprints,
        neardup.near_duplicates,
        lambda d: toxicity.toxicity_scores(d, labels),
        repeats.repeat_digests,
        lambda d: mixing.chosen(queries.with_domain(d), queries.PATH, queries.mix_weights(), 0.8, 2, 7),
        lambda d: encode_digests(d, VOCABULARY),
    ):
        assert run(odd).count() == len(ROWS)
        assert run(none).count() == 0
    assert quality.quality_scores(odd, labels.filter("false")).count() == len(ROWS)
    assert toxicity.toxicity_scores(odd, labels.filter("false")).agg(F.max("score")).first()[0] < 0.5


def test_licences_find_all_places(odd, docs):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for table in (odd.filter("doc_id is not null"), docs):
        for row in licences.scan_licences(table).join(table.select("doc_id", "text").distinct(), "doc_id").collect():
            words = word.findall((row.text or "").translate(LOWER))
            found = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(words))
                     if words[i : i + len(phrase.split())] == phrase.split()]
            places = [i for i, _ in found]
            want = len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))
            assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == want
            assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text.translate(LOWER)) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_fingerprints_and_edits(docs):
    texts = texts_of(docs)
    ids, errors = sorted(texts), []
    got = {r.doc_id: r for r in fingerprints.document_fingerprints(docs).collect()}
    for at, key in enumerate(ids):
        text, following = texts[key], texts[ids[(at + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        row = got[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = shingles(text), shingles(edited)
        errors.append(row.near_edited - (len(a & b) / len(a | b) if a | b else 1.0))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07
    assert len({r.fingerprint for r in got.values() if texts[r.doc_id] == texts[0]}) == 1


def test_fingerprint_of_one_row_and_of_nothing(odd):
    one = fingerprints.document_fingerprints(odd.filter("doc_id = 1")).first()
    assert one.near_next == 1.0
    empty = fingerprints.document_fingerprints(odd.filter("doc_id in (2, 3)")).collect()
    assert {(r.n_chars, r.fingerprint, r.near_edited, r.near_next) for r in empty} == {(0, "", 1.0, 1.0)}


def joined(pairs, nodes):
    head = {n: n for n in nodes}

    def root(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        head[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_near_duplicates_are_exact(spark, docs):
    family = [" ".join(f"w{(i * 7) % 300}" if i not in range(k, 300, 60) else f"x{k}" for i in range(300)) for k in range(40)]
    more = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(family + family[:3])], "doc_id long, text string")
    table = docs.select("doc_id", "text").unionAll(more)
    sets = {k: shingles(t) for k, t in texts_of(table).items()}
    keys = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = joined(pairs, keys)
    got = {r.doc_id: r for r in neardup.near_duplicates(table).collect()}
    assert {k: (len(sets[k]), want[k], want[k] == k) for k in keys} == {
        k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()
    }


def test_null_keys_and_empty_sets_link_nothing(odd):
    rows = {r.doc_id: r for r in neardup.near_duplicates(odd).collect()}
    assert rows[2].n_shingles == rows[3].n_shingles == 0 and rows[2].kept and rows[3].component_id == 3
    assert rows[7].component_id == 6 and not rows[7].kept and rows[None].kept


def test_compressed_registers_estimate_similarity():
    draw = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        both = np.unique(draw.integers(0, 2**64, 400, dtype=np.uint64))
        a, b = (neardup.registers_of(np.sort(both[s])) for s in (slice(0, 350), slice(50, 400)))
        filled = ((a > 0) | (b > 0)).sum()
        errors.append(neardup.corrected(((a == b) & (a > 0)).sum(), filled) - 300 / 400)
    assert abs(np.mean(errors)) < 0.02


def test_components_of_a_chain_a_star_and_nulls(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(None, 3), (7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}


def covered_by_definition(texts, length):
    starts = {}
    for key, data in texts:
        for p in range(len(data) - length + 1):
            starts.setdefault(data[p : p + length], []).append((key, p))
    cover = {key: bytearray(len(data)) for key, data in texts}
    for places in starts.values():
        if len(places) > 1:
            for key, p in places:
                cover[key][p : p + length] = b"\1" * length
    return cover


@pytest.mark.parametrize("most_together", [repeats.MOST_TOGETHER, 2])
def test_repeats_match_the_definition(spark, most_together):
    draw = np.random.default_rng(5)
    letters = lambda n: "".join(draw.choice(list("abcdé "), n))
    passage, other = letters(300), letters(90)
    texts = [letters(50) + passage + letters(40), passage[:200] + letters(30) + passage[90:], "ab" * 200, letters(99)]
    texts += [letters(int(draw.integers(5, 60))) + passage[30:220] + letters(20) for _ in range(6)] + [other + other, "", texts[0]]
    texts.append(None)
    length = 64
    want = covered_by_definition([(i, (t or "").encode()) for i, t in enumerate(texts)], length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeats.covered(df, length, most_together)
    spans = {r._row: r for r in df.withColumn("_row", repeats.row_key()).join(found.withColumnRenamed("row", "_row"), "_row").collect()}
    by_doc = {r.doc_id: repeats.joined_spans([s.asDict() for s in r.spans]) for r in spans.values()}
    for key, cover in want.items():
        own = bytearray(len(cover))
        for low, high in by_doc.get(key, []):
            own[low:high] = b"\1" * (high - low)
        assert own == cover, key


@pytest.mark.parametrize("most_together", [repeats.MOST_TOGETHER, 2])
def test_repeats_just_below_the_length_are_left_alone(spark, most_together):
    draw = np.random.default_rng(11)
    letters = lambda n: "".join(draw.choice(list("abcdefgh "), n))
    passage = letters(63)
    texts = [letters(70) + chr(ord("A") + i) + passage + chr(ord("a") + i) + letters(70) for i in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert repeats.covered(df, 64, most_together).isEmpty()
    digests = repeats.repeat_digests(df, 64).collect()
    assert len(digests) == 8 and {(r.n_removed, r.n_spans) for r in digests} == {(0, 0)}


def test_repeat_digests_on_documents(docs):
    got = {r.doc_id: r for r in repeats.repeat_digests(docs).collect()}
    texts = {k: t.encode() for k, t in texts_of(docs).items()}
    cover = covered_by_definition(list(texts.items()), 400)
    for key, data in texts.items():
        kept = bytes(b for b, c in zip(data, cover[key]) if not c)
        assert (got[key].n_bytes, got[key].n_removed) == (len(data), sum(cover[key]))
        assert got[key].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_byte_pairs_equal_the_tokenizer(odd, docs):
    reference = Tokenizer.from_file(VOCABULARY)
    for table in (odd.filter("doc_id is not null"), docs):
        got = {r.doc_id: r for r in encode_digests(table, VOCABULARY).collect()}
        for key, text in texts_of(table).items():
            ids = reference.encode(text, add_special_tokens=False).ids
            decoded = reference.decode(ids, skip_special_tokens=False)
            assert got[key].n_tokens == len(ids)
            assert got[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert got[key].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_token_files_are_scanned_across_blocks(spark, odd):
    reference = Tokenizer.from_file(VOCABULARY)
    reference.encode_special_tokens = True
    folder = fresh_path(spark, "token-test")
    tokenfiles.write_token_files(odd, VOCABULARY, folder)
    want = sorted(len(reference.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect())
    for block in (3, 1000, 1 << 20):
        rows = tokenfiles.token_counts(spark, folder, block_tokens=block).collect()
        assert sorted(r.n_tokens for r in rows) == want
        by_file = {}
        for r in sorted(rows, key=lambda r: (r.file, r.doc_no)):
            number, start = by_file.get(r.file, (0, 0))
            assert (r.doc_no, r.first_token) == (number, start)
            by_file[r.file] = number + 1, start + r.n_tokens + 1


def test_nearest_recall_and_exact_scores(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    odd = spark.createDataFrame(
        [(10**6, None), (10**6 + 50, [0.0] * 64), (None, [1.0] * 64), (10**6 + 1, [float("nan")] * 64), (10**6 + 2, [1.0, None])],
        "vec_id long, embedding array<float>",
    )
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    got = {}
    for r in neighbours.nearest(table.select("vec_id", "embedding").unionAll(odd)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ids = np.array(sorted(rows))
    every = np.stack([rows[i] for i in ids])
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    hits = total = 0
    for query in ids[ids % 50 == 0].tolist():
        score = every @ every[np.searchsorted(ids, query)]
        best = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != query][:5]
        found = [v for _, v, _ in sorted(got[query])]
        hits, total = hits + len(set(best) & set(found)), total + 5
        for _, v, s in got[query]:
            assert s == pytest.approx(float(score[np.searchsorted(ids, v)]), abs=1e-12)
    assert hits >= 0.9 * total
    assert neighbours.nearest(table.limit(0)).count() == 0
    assert neighbours.nearest(table.filter("vec_id in (0, 1, 2)")).count() == 2


def accuracy(scores, truth, column, spark):
    rows = scores.join(truth.select("doc_id", column), "doc_id").filter("held_out").collect()
    return np.mean([r.predicted == r[column] for r in rows])


def test_models_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, truth = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    assert accuracy(quality.quality_scores(docs, truth), truth, "quality", spark) >= 0.95
    assert accuracy(toxicity.toxicity_scores(docs, truth), truth, "toxic", spark) >= 0.9


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(3)
    size = 1 << toxicity.BITS
    model = toxicity.ToxicModel(*(draw.normal(size=size) for _ in range(3)), -0.3, draw.normal(size=(2, 2)))
    text = "some words that lean here and there".encode()
    rows, _, _, ranges = toxicity.word_rows(np.frombuffer(text, np.uint8), np.array([0, 10, 10, len(text)]))
    got, lean = model.sweep(rows, ranges), model.leanings(rows, ranges)
    for a, b in zip(ranges[:-1], ranges[1:]):
        total, toxic = 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            states = [(code >> i) & 1 for i in range(b - a)]
            score = sum(lean[a + i] for i, s in enumerate(states) if s)
            weight = np.exp(score + sum(model.steps[x, y] for x, y in zip(states, states[1:])))
            total, toxic = total + weight, toxic + weight * np.array(states)
        assert np.allclose(got[a:b], toxic / total)


def test_budgets_fill_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "x", 1000)], "d string, l string, tokens long")
    plan = {(r.d, r.l): r.budget for r in mixing.leaf_budgets(leaves, ["d", "l"], [F.lit(1.0), F.lit(1.0)], 120, 1).collect()}
    assert plan == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 60}
    plan = {(r.d, r.l): r.budget for r in mixing.leaf_budgets(leaves, ["d", "l"], [F.lit(1.0), F.lit(1.0)], 400, 1).collect()}
    assert plan == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 290}


def test_mixture_is_a_prefix_of_seeded_epochs(docs):
    table = queries.with_domain(docs)
    rows = mixing.chosen(table, queries.PATH, queries.mix_weights(), 0.8, 2, 7).collect()
    leaves = table.withColumn("n", mixing.token_count()).groupBy(*queries.PATH).agg(F.sum("n").alias("tokens"))
    total = 0.8 * sum(r.tokens for r in leaves.collect())
    plan = {tuple(r[c] for c in queries.PATH): r for r in mixing.leaf_budgets(leaves, queries.PATH, queries.mix_weights(), total, 2).collect()}
    by_leaf = {}
    for r in rows:
        by_leaf.setdefault(tuple(r[c] for c in queries.PATH), []).append(r)
    for leaf, own in by_leaf.items():
        whole, rest = divmod(plan[leaf].budget, plan[leaf].tokens)
        order = sorted(own, key=lambda r: hashlib.md5(f"7:{whole}:{r.doc_id}".encode()).hexdigest())
        ends = np.cumsum([r.n_tokens for r in order])
        assert [r.copies for r in order] == [whole + int(rest > 0 and e <= rest) for e in ends]


def test_pipeline_stages(spark, sf_dir, docs):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
        assert frame.columns == docs.columns, name
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and out.filter("n_tokens * 4 != octet_length(ids)").count() == 0
    extra = docs.withColumn("score", F.lit(1)).withColumn("spans", F.lit("s"))
    assert corpus_pipeline.unrepeated(spark, corpus_pipeline.good_quality(spark, extra, sf_dir), sf_dir).columns == extra.columns


def test_pipeline_keeps_one_row_of_each_group(spark, sf_dir):
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(200))
    rows = [
        (None, text(0)), (None, text(0)), (None, text(0)),  # only null ids
        (5, text(1)), (5, text(1)), (None, text(1)), (7, text(1)),  # a repeated row, a null id and another id
        (3, text(2)), (8, text(2)), (8, text(3)),  # one id with a copy and with a text of its own
        (None, text(4)), (9, text(5)), (9, None), (None, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.first_copies(spark, frame, sf_dir)
    same = lambda df: sorted([tuple(r) for r in df.collect()], key=repr)
    want = [(None, text(0)), (5, text(1)), (3, text(2)), (8, text(3)), (None, text(4)), (9, text(5)), (9, None), (None, "")]
    assert kept.columns == frame.columns and same(kept) == sorted(want, key=repr)
    # One row of each text is left, so the next stage has nothing to cut.
    assert same(corpus_pipeline.unrepeated(spark, kept, sf_dir)) == sorted(want, key=repr)


def test_registered(spark):
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")] == list(range(1, 14))
