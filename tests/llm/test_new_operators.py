"""Hilbert shards, spelling variants and tokenizer alignment against plain definitions, and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwright.llm import alignment, hilbert, queries, spelling, stored
from millwright.llm.alignment import align_tokenizers
from millwright.llm.hilbert import document_shards, hilbert_shards, write_shards
from millwright.llm.spelling import spelling_variants
from millwright.session import fresh_path

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 977} straße{i % 31} ééàü" for i in range(20_000))
TEXTS = [
    "plain words here", None, "", "  two  spaces ", "a\nb\t\tc\r\n", "漢字 and \U0001f600 \U0001d4b3", "<s> <|endoftext|> <0x41> <unk>",
    "▁ is not a space", "aaaaaaaaaaaaaaaaaaaa aaa", "ﬁ Å é́ ½ ™  x y", "x" * 30_000, "^" * 30_000, " " * 30_000, LONG,
    "plain words here", "\x00\x01 \x7f", "1234567890 12 3", "don't we'll I'M", "　 \u0085 z", "plain words here",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, repeated and null keys, and columns whose names clash with results."""
    rows = [(None if i == 3 else min(i, 17), t, None if i % 5 == 0 else "en", f"s{i % 3}", 1.5, "x", 3, 4) for i, t in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, source string, size double, word string, row int, n_a int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_neighbours_on_the_curve_are_neighbours_in_space(spark):
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        axes = [f"a{i}" for i in range(dims)]
        cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=dims)), axes)
        rows = sorted(hilbert.curve_index(cells, axes, bits, "at").collect(), key=lambda r: r["at"])
        assert [r["at"] for r in rows] == list(range(1 << bits * dims))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[x] - b[x]) for x in axes) == 1


def test_shards_of_awkward_rows(odd):
    for law in hilbert.LAWS:
        rows = document_shards(odd, 8, law).collect()
        assert len(rows) == len(TEXTS)
        size = lambda t: len((t or "").encode()) + 1
        want = Counter((size(t), zlib.crc32((t or "").encode())) for t in TEXTS)
        assert Counter((r.size, r.text_crc32) for r in rows) == want
        shards = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
        assert all(slots == list(range(len(slots))) for slots in shards.values())
        if law == "rows":
            assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
        else:
            even, most = sum(map(size, TEXTS)) / 8, max(map(size, TEXTS))
            assert all(abs(sum(r.size for r in rows if r.shard == s) - even) <= most for s in range(8))
    assert document_shards(odd.filter("false")).count() == 0
    assert document_shards(odd.limit(3)).select("shard").distinct().count() == 3
    text_keys = document_shards(odd.withColumn("doc_id", F.col("doc_id").cast("string"))).collect()
    assert len(text_keys) == len(TEXTS) and {type(r.doc_id) for r in text_keys} == {str, type(None)}
    with pytest.raises(ValueError):
        hilbert_shards(odd.select("doc_id", "size", F.lit(1).alias("slot")), {"doc_id": "width"}, F.lit("x"))


def test_shards_do_not_depend_on_the_input_partitions(docs):
    one = document_shards(docs.coalesce(1)).select("doc_id", "shard", "slot")
    other = document_shards(docs.repartition(7)).select("doc_id", "shard", "slot")
    assert one.exceptAll(other).isEmpty()


def test_a_cell_of_any_size_is_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "PIECE_ROWS", 7)
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same").alias("k"), F.lit(2).cast("long").alias("size"))
    found = hilbert_shards(rows, {"k": "value"}, F.col("doc_id").cast("string"), 8).collect()
    assert sorted((r.shard, r.slot) for r in found) == [(s, i) for s in range(8) for i in range(63 - s % 2)]


def test_many_values_of_a_dimension(spark, monkeypatch):
    """Dictionaries beyond the bound of a broadcast give the same parts."""
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("k"), F.lit(1).cast("long").alias("size"))
    run = lambda: hilbert_shards(rows, {"k": "value", "doc_id": "width"}, F.col("doc_id").cast("string")).collect()
    before = sorted(run())
    monkeypatch.setattr(hilbert, "SENT_KEYS", 5)
    monkeypatch.setattr(stored, "SENT_KEYS", 5)
    assert sorted(run()) == before


def test_written_shards_have_narrow_ranges_and_all_rows(spark, docs):
    folder = fresh_path(spark, "shards")
    write_shards(docs.withColumns({"_crc": F.lit(1), "_slot": F.lit(2)}), folder)
    docs = docs.withColumns({"_crc": F.lit(1), "_slot": F.lit(2)})
    with pytest.raises(ValueError, match="shard"):
        write_shards(docs.withColumn("shard", F.lit(1)), folder)
    back = spark.read.parquet(folder)
    assert back.drop("shard").exceptAll(docs).isEmpty() and back.count() == docs.count()
    assert set(docs.columns) < set(back.columns)
    # A source stands in few shards, though it is only one of four dimensions.
    shards = back.groupBy("source").agg(F.countDistinct("shard").alias("n")).agg(F.avg("n")).first()[0]
    assert shards < 5


def plain_words(rows, slips):
    found = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if slips and h % slips == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return found


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = sorted((a, b), key=len, reverse=True)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts, letters, least, times):
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= least}
    around = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in around.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= times * words[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(around[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def found_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("most", [2_000, 3])
def test_spelling_variants_equal_brute_force(spark, most):
    """Also where every list is halved down to single places."""
    rng = random.Random(3)
    stems = ["ababab", "bababa", "aaaaaa", "straßé", "ÀÖ×÷ÿü", "wordwordword", "abcdefghi"]
    words = []
    for i in range(900):
        w = list(rng.choice(stems))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "é", "ß", "ÿ"])
        words.append("".join(w))
    rows = [(i, " ".join(rng.choice(words[: 1 + 60 * (1 + i % 15)]) for _ in range(60)).upper() + ".x,Y") for i in range(30)]
    rows += [(7, None), (None, "ababab ababab"), (8, ""), (9, "long" * 5_000 + " " + "long" * 4_999 + "lonk")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Letters beyond ASCII are not lowered.
    want = plain_variants(plain_words(rows, 5), 5, 1, 2)
    assert len(want) > 100 and any(v[4] > 3 for v in want)
    got = spelling_variants(docs, slips=5, least_letters=5, least_count=1, times=2, most_words=most)
    assert found_variants(got) == want


def test_spelling_variants_of_awkward_rows(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    counts = plain_words(rows, 199)
    got = found_variants(spelling_variants(odd, slips=199, least_count=1))
    assert got == plain_variants(counts, 6, 1, 5)
    assert spelling_variants(odd.filter("false")).count() == 0
    assert spelling_variants(odd.filter("text is null or text = ''")).count() == 0
    chain = odd.sparkSession.createDataFrame(
        [(1, "abcdefg " * 200 + "abcdefh " * 30 + "abcdeih " * 5 + "abcdeig " * 5)], "doc_id long, text string"
    )
    roots = {r.word: (r.form, r.root) for r in spelling_variants(chain).collect()}
    assert roots == {
        "abcdefg": (None, "abcdefg"), "abcdefh": ("abcdefg", "abcdefg"),
        "abcdeih": ("abcdefh", "abcdefg"), "abcdeig": ("abcdefg", "abcdefg"),
    }


def plain_alignment(rows):
    """The definition, token by token."""
    first = Tokenizer.from_file(A_PATH)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = {c: b for c, b in alignment_letters().items()}
    spell_a = lambda i: bytes(letters[c] for c in first.id_to_token(i))

    def spell_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    parsed, held = [], Counter()
    for key, text in rows:
        data = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(map(spell_a, a)) != data or b"".join(map(spell_b, b)) != data:
            parsed.append((key, [], [], [], ""))
            continue
        ends = lambda ids, spell: list(itertools.accumulate(len(spell(i)) for i in ids))
        ends_a, ends_b = ends(a, spell_a), ends(b, spell_b)
        common = sorted(set(ends_a) & set(ends_b))
        spelled, i, j, links, p, q = [], 0, 0, [], 0, 0
        for end in common:
            ga, gb = [], []
            while i < len(a) and ends_a[i] <= end:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= end:
                gb.append(b[j])
                j += 1
            spelled.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        while p < len(a) and q < len(b):
            links.append((a[p], b[q]))
            step = ends_a[p], ends_b[q]
            p, q = p + (step[0] <= step[1]), q + (step[1] <= step[0])
        held.update(set(links))
        parsed.append((key, a, b, links, hashlib.sha256(";".join(spelled).encode()).hexdigest(), len(common)))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (p[0], len(p[1]), len(p[2]), p[5] if p[4] else 0, len(p[3]), sum(held[k] == most[k[0]] for k in p[3]), sum(held[k] for k in p[3]), p[4])
            for p in parsed
        ),
        key=repr,
    )


def alignment_letters():
    from millwright.llm.bpe import byte_letters

    return byte_letters()


def found_alignment(df):
    return sorted(
        ((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr
    )


@pytest.mark.parametrize("most_sent", [500_000, 50])
def test_alignment_equals_brute_force(odd, docs, most_sent):
    """Also where most pairs are beyond the bound of what is sent to all tasks."""
    for table in (odd, docs.limit(60)):
        rows = [(r.doc_id, r.text) for r in table.collect()]
        assert found_alignment(align_tokenizers(table, A_PATH, B_PATH, most_sent=most_sent)) == plain_alignment(rows)


def test_alignment_of_awkward_tables(odd):
    assert align_tokenizers(odd.filter("false"), A_PATH, B_PATH).count() == 0
    empty = align_tokenizers(odd.filter("text is null or text = ''"), A_PATH, B_PATH).collect()
    assert len(empty) == 2 and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in empty)


def test_identity_map_keeps_the_bytes():
    both = alignment.vocabularies(A_PATH, B_PATH)
    known = both.same >= 0
    assert known.sum() > 10_000
    assert all(both.first.bytes_of[a] == both.second.bytes_of[both.same[a]] for a in known.nonzero()[0].tolist())


def test_columns_of_the_new_queries(spark, sf_dir):
    assert queries.op11_hilbert_shards(spark, sf_dir).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert dict(queries.op12_spelling_variants(spark, sf_dir).dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"
    }
    wide = dict(queries.op13_tokenizer_alignment(spark, sf_dir).dtypes)
    assert wide.pop("groups_sha256") == "string" and set(wide.values()) == {"bigint"}
