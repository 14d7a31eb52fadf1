"""Quality and toxicity scores against plain loops: features, fitting, marginals, scores and offsets."""

import functools
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import labelled, quality, toxicity

M = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M
    return x ^ (x >> 31)


def span(data):
    return mix((sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(data)) + len(data)) & M)


def quality_rows(text):
    data = text.encode()
    hashes = [span(w) for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    rows = [h >> 46 for h in hashes] + [mix((b - a) & M) >> 46 for a, b in zip(hashes, hashes[1:])]
    for size in (3, 4):
        for i in range(len(data) - size + 1):
            g = sum(data[i + j] << 8 * j for j in range(size))
            g = (g + size) * 2654435761 & 0xFFFFFFFF
            g = (g ^ (g >> 15)) * 2246822519 & 0xFFFFFFFF
            rows.append(g >> 14)
    return rows


TEXTS = ["good words here", "bad bad  bad", "", "é ü words\n\nhere", "x", "ab", "good good words", "junk 123 junk 123 junk"]
LABELS = [1, 0, 1, 1, 0, 0, 1, 0]


def plain_quality(model, text):
    rows = quality_rows(text)
    total = math.fsum(float(model.rows[r]) for r in rows) / max(len(rows), 1)
    return 1 / (1 + math.exp(-(model.shift + total)))


def plain_fit(texts, labels, size=8, epochs=5, rate=1.0, seed=7):
    """The same steps, one number at a time."""
    shift = math.log((sum(labels) + 1) / (len(labels) - sum(labels) + 1))
    draw = np.random.default_rng(seed)
    table = draw.uniform(-1 / size, 1 / size, (1 << quality.BITS, size)).astype(np.float32).astype(float)
    heads, bias = [[0.0] * size, [0.0] * size], [0.0, shift]
    bags = []
    for text in texts:
        rows = quality_rows(text)
        bags.append({r: rows.count(r) / len(rows) for r in sorted(set(rows))})
    done, steps = 0, epochs * len(texts)
    for _ in range(epochs):
        for at in draw.permutation(len(texts)):
            bag = bags[at]
            mean = [sum(s * table[r][d] for r, s in bag.items()) for d in range(size)]
            odds = [sum(h * m for h, m in zip(heads[c], mean)) + bias[c] for c in (0, 1)]
            top = max(odds)
            error = [math.exp(o - top) for o in odds]
            error = [e / sum(error) for e in error]
            error[labels[at]] -= 1
            step = rate * (1 - done / steps)
            back = [error[0] * heads[0][d] + error[1] * heads[1][d] for d in range(size)]
            for c in (0, 1):
                heads[c] = [h - step * error[c] * m for h, m in zip(heads[c], mean)]
                bias[c] -= step * 0.1 * error[c]
            for r, s in bag.items():
                for d in range(size):
                    table[r][d] -= step * math.sqrt(s) * back[d]
            done += 1
    lean = {r: sum(table[r][d] * (heads[1][d] - heads[0][d]) for d in range(size)) for bag in bags for r in bag}
    return lean, bias[1] - bias[0]


def test_quality_equals_plain_loops(spark, sf_dir):
    model = quality.fit(TEXTS, LABELS)
    lean, shift = plain_fit(TEXTS, LABELS)
    assert model.shift == pytest.approx(shift, abs=1e-4)
    assert all(model.rows[r] == pytest.approx(v, abs=2e-4) for r, v in lean.items())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learned = quality.fit(*labelled.labelled_sample(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels, "quality"))
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    for row in quality.score_quality(docs.unionAll(more), learned).collect():
        assert row.score == pytest.approx(plain_quality(learned, row.text or ""), abs=1e-9)


def plain_words(text):
    """Words as (start, end) in code points, and the rows of each: the word, then its heads."""
    out = []
    for m in re.finditer(r"[A-Za-z\u0080-\U0010FFFF]+", text):
        word = "".join(c.lower() if "A" <= c <= "Z" else c for c in m.group()).encode()
        rows = [(span(word) >> 46) or 1]
        for size in toxicity.HEADS:
            rows.append(((mix((span(word[:size]) + size) & M) >> 46) or 1) if len(word) > size else 0)
        out.append((m.start(), m.end(), rows))
    return out


def plain_toxicity(model, text):
    """Score and spans by sums over forward and backward weights, word by word."""
    words = plain_words(text)
    if not words:
        return 0.0, []
    odds = []
    for i, (_, _, rows) in enumerate(words):
        lean = sum(float(model.word[r]) for r in rows) + model.shift
        lean += float(model.before[words[i - 1][2][0] if i else 0]) + float(model.after[words[i + 1][2][0] if i + 1 < len(words) else 0])
        odds.append(math.exp(min(max(lean, -30), 30)))
    t = np.exp(model.steps)
    ahead = [(1.0, odds[0])]
    for o in odds[1:]:
        a, b = ahead[-1]
        now = (a * t[0, 0] + b * t[1, 0], (a * t[0, 1] + b * t[1, 1]) * o)
        ahead.append((now[0] / sum(now), now[1] / sum(now)))
    back = [(1.0, 1.0)]
    for o in reversed(odds[1:]):
        a, b = back[-1]
        now = (t[0, 0] * a + t[0, 1] * o * b, t[1, 0] * a + t[1, 1] * o * b)
        back.append((now[0] / sum(now), now[1] / sum(now)))
    back.reverse()
    marginal = [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(ahead, back)]
    spans = []
    for (start, end, _), m in zip(words, marginal):
        hot = m >= toxicity.TOXIC_FROM
        if hot and spans and spans[-1][3]:
            spans[-1] = (spans[-1][0], end, max(spans[-1][2], m), True)
        elif hot:
            spans.append((start, end, m, True))
        elif spans:
            spans[-1] = (*spans[-1][:3], False)
    return max(marginal), [s[:3] for s in spans]


def test_toxicity_equals_plain_loops(spark):
    bad = ["You are a vileword and a Vilewords", "such vileword talk", "vileword vileword", "é vileword, ü", "a vileword b", "the vileword is", "oh vileword no"]
    fine = [f"some friendly talk about thing{i} and more of it" for i in range(5)]
    draw = np.random.default_rng(3)
    word, before, after = (draw.normal(0, 0.3, 1 << toxicity.BITS).astype(np.float32) for _ in range(3))
    word[0] = 0.0
    word[plain_words("vileword")[0][2][0]] = 9.0
    model = toxicity.ToxicModel(word, before, after, -4.0, np.array([[1.0, -0.8], [-0.9, 0.5]]))
    texts = [*bad, *fine[:5], "", None, "... 123 !", "VILEWORD\n\nfriendly vileword", "ünïcode 漢字 vileword 漢 vilewordish", "word " * 500 + "vileword"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    scored = toxicity.score_toxicity(docs, model).collect()
    for row in scored:
        score, spans = plain_toxicity(model, row.text or "")
        assert row.score == pytest.approx(score, abs=1e-6)
        assert [(s.start, s.end) for s in row.spans] == [(a, b) for a, b, _ in spans]
        assert [s.score for s in row.spans] == pytest.approx([p for _, _, p in spans], abs=1e-6)
    assert all(r.spans for r in scored if r.doc_id < len(bad) and "vileword " in r.text)
    assert all(r.score < 0.5 for r in scored if len(bad) <= r.doc_id < len(bad) + 5)
    assert docs.select(labelled.held_out(F.col("doc_id")).alias("h")).filter("h").count() < docs.count()


def plain_fingerprint(text):
    """128 digits from the definition: bins, minima, lenders, low bits."""
    import xxhash

    signed = lambda h: h - (1 << 64) if h >> 63 else h
    chained = lambda parts: functools.reduce(lambda seed, p: xxhash.xxh64_intdigest(p, seed), parts, 42)
    words = [w.encode() for w in re.split("[\x20\x09-\x0D]+", text.lower()) if w]
    runs = [words[i : i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    hashes = sorted({signed(chained(r)) for r in runs})
    if not hashes:
        return ""
    least = {}
    for h in hashes:
        least.setdefault(h >> 57, h)
    filled = sorted(least)
    digits = []
    for b in range(-64, 64):
        if b not in least:
            order = [
                (signed(chained([(b & M).to_bytes(8, "little"), (f & M).to_bytes(8, "little")])) >> 7, i) for i, f in enumerate(filled)
            ]
            digits.append(least[filled[min(order)[1]]] & 15)
        else:
            digits.append(least[b] & 15)
    return "".join("0123456789abcdef"[d] for d in digits)


def test_fingerprint_digits_equal_the_definition(spark, sf_dir):
    from millwright.llm import fingerprints

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    rows = [r.text for r in docs.collect()] + ["", "one two", "  A b\tc d e f g  ", "é ü ß x y z", "w " * 30]
    table = spark.createDataFrame([(t,) for t in rows], "text string")
    for r in table.select("text", fingerprints.fingerprint(F.col("text")).alias("f")).collect():
        assert r.f == plain_fingerprint(r.text)


def plain_shares(children, total):
    """Budgets of the children ``{name: (weight, room)}`` by filling the fullest first."""
    budget, left, open_ = {}, total, dict(children)
    for name, (weight, room) in children.items():
        if weight <= 0:
            budget[name] = 0.0
            del open_[name]
    while open_:
        level = left / sum(w for w, _ in open_.values())
        name, (weight, room) = min(open_.items(), key=lambda c: c[1][1] / c[1][0])
        if room > weight * level:
            budget.update({n: w * level for n, (w, _) in open_.items()})
            break
        budget[name] = room
        left -= room
        del open_[name]
    return budget


def plain_mixture(rows, weight, total, epochs, seed):
    """``{row: copies}`` for ``(row, doc_id, path, tokens)``, node by node and document by document."""
    tokens = {}
    for _, _, path, n in rows:
        tokens[path] = tokens.get(path, 0) + n
    budgets = {(): total * sum(tokens.values())}
    for depth in range(3):
        for parent in {p[:depth] for p in tokens}:
            names = {p[: depth + 1] for p in tokens if p[:depth] == parent}
            room = {n: epochs * sum(t for p, t in tokens.items() if p[: depth + 1] == n) for n in names}
            budgets |= plain_shares({n: (weight(n), room[n]) for n in sorted(names, key=str)}, budgets[parent])
    copies = {}
    for path, held in tokens.items():
        budget = math.floor(budgets[path] + 1e-9)
        whole = budget // held if held else 0
        rest, used = budget - whole * held, 0
        own = [r for r in rows if r[2] == path]
        full = False
        for row, key, _, n in sorted(own, key=lambda r: hashlib.md5(f"{seed}:{whole}:{'null' if r[1] is None else r[1]}".encode()).hexdigest()):
            used += n
            full = full or used > rest
            copies[row] = whole + int(rest > 0 and not full)
    return copies


def test_mixture_equals_plain_choice(spark, sf_dir):
    from millwright.llm import mixing, queries

    docs = queries.with_domain(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    split = re.compile("[^\x20\x09-\x0D]+")
    rows = [(r.doc_id, r.doc_id, (r.domain, r.lang, r.source), len(split.findall(r.text or ""))) for r in docs.collect()]

    def weight(path):
        if len(path) == 1:
            return queries.DOMAINS.get(path[0], 0.1)
        return queries.LANGUAGES.get(path[1], 0.05) if len(path) == 2 else 1.0

    for total, epochs in ((0.8, 2), (0.1, 1), (1.9, 2)):
        want = plain_mixture(rows, weight, total, epochs, 7)
        found = {r.doc_id: r.copies for r in mixing.chosen(docs, queries.PATH, queries.mix_weights(), total, epochs, 7).collect()}
        # A budget that is a whole number but for the last digit may fall on either side.
        assert sum(found[k] != v for k, v in want.items()) <= 2 and found.keys() == want.keys()
