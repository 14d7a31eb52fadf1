"""The results of some training-data queries in DuckDB SQL, over the same tables."""

from __future__ import annotations

from millwright.llm.hilbert import DOCUMENT_DIMS, PIECE_ROWS, STEPS, curve_tables  # noqa: F401
from millwright.llm.spelling import LEAST_COUNT, LEAST_LETTERS, TIMES

#: What each byte does to a crc32, as a list.
CHECKSUMS = (
    "checksums AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), "
    "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps)"
)


def utf8(text: str) -> str:
    """The UTF-8 bytes of a text, as a list."""
    return (
        f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN ch = '' THEN []::BIGINT[] "
        "WHEN unicode(ch) < 128 THEN [unicode(ch)] "
        "WHEN unicode(ch) < 2048 THEN [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)] "
        "WHEN unicode(ch) < 65536 THEN [224 + (unicode(ch) >> 12), 128 + ((unicode(ch) >> 6) & 63), 128 + (unicode(ch) & 63)] "
        "ELSE [240 + (unicode(ch) >> 18), 128 + ((unicode(ch) >> 12) & 63), 128 + ((unicode(ch) >> 6) & 63), 128 + (unicode(ch) & 63)] END))"
    )


def crc32(text: str) -> str:
    """The crc32 of a text; the query has ``steps`` of ``CHECKSUMS`` in scope."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {utf8(text)}::BIGINT[]), "
        "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]::BIGINT)), 4294967295::BIGINT)"
    )


def sharding(shards: int = 8, bits: int = 4) -> str:
    """Shards of equal numbers of documents along the Hilbert curve."""
    dims = len(DOCUMENT_DIMS)
    number, entry, direction = curve_tables(dims)
    full = (1 << dims) - 1
    step = (
        "CASE WHEN doc_id IS NULL THEN -1 ELSE "
        f"(doc_id::HUGEINT - min(doc_id) OVER ()::HUGEINT) * {STEPS} // (max(doc_id) OVER () - min(doc_id) OVER () + 1) END"
    )
    parts = [f"WITH {CHECKSUMS}"]
    parts.append(
        "slim AS (SELECT doc_id, source, lang, strlen(coalesce(text, '')) + 1 AS size, "
        f"{crc32('coalesce(text, chr(0)[1:0])')} AS text_crc32 FROM documents, checksums)"
    )
    parts.append(
        "steps AS (SELECT *, coalesce('v' || source, 'n') AS v0, coalesce('v' || lang, 'n') AS v1, "
        "length(bin(size)) * 4 + ((size >> greatest(length(bin(size)) - 3, 0)) & 3) AS v2, "
        f"{step} AS v3 FROM slim)"
    )
    cells = ", ".join(
        f"floor((rank() OVER (ORDER BY v{i}) - 1) * {1 << bits} / count(*) OVER ())::INT AS x{i}" for i in range(dims)
    )
    parts.append(f"level{bits} AS (SELECT *, {cells}, 0 AS corner, 0 AS axis, 0 AS cell FROM steps)")
    turned = lambda x, by: f"((({x}) << ({by})) | (({x}) >> ({dims} - ({by})))) & {full}"
    for level in reversed(range(bits)):
        here = " + ".join(f"((x{i} >> {level}) & 1) * {1 << i}" for i in range(dims))
        parts.append(
            f"part{level} AS (SELECT *, {number}[({turned(f'xor({here}, corner)', f'{dims} - (axis + 1)')}) + 1] AS part FROM level{level + 1})"
        )
        turn = turned(f"{entry}[part + 1]", "axis + 1")
        parts.append(
            f"level{level} AS (SELECT * EXCLUDE (part) REPLACE (cell * {1 << dims} + part AS cell, "
            f"xor(corner, {turn}) AS corner, "
            f"(axis + {direction}[part + 1] + 1) % {dims} AS axis) FROM part{level})"
        )
    return ",\n".join(parts) + f"""
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM (SELECT *, place * {shards} // count(*) OVER () AS shard FROM (
    SELECT *, row_number() OVER (
        ORDER BY cell, substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || text_crc32::VARCHAR), 1, 8), doc_id, lang, source, size, text_crc32
    ) - 1 AS place FROM level0))"""


def spelling(slips: int = 199) -> str:
    """Words, their near words by what is left when a letter is taken out, and their forms."""
    return f"""WITH RECURSIVE {CHECKSUMS},
runs AS (SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
summed AS (SELECT w, n, {crc32("doc_id::VARCHAR || ':' || w")} AS h FROM runs, checksums),
slipped AS (SELECT CASE WHEN h % {slips} = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w, n FROM summed),
vocabulary AS (SELECT w AS word, sum(n)::BIGINT AS n FROM slipped WHERE length(w) >= {LEAST_LETTERS} GROUP BY w HAVING sum(n) >= {LEAST_COUNT}),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT c.word, v.word, v.n FROM cuts c JOIN vocabulary v ON c.rest = v.word
    UNION SELECT v.word, c.word, c.n FROM cuts c JOIN vocabulary v ON c.rest = v.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS near FROM near GROUP BY word),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {TIMES} * v.n THEN near END AS form,
    CASE WHEN most >= {TIMES} * v.n THEN most END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM forms UNION ALL
    SELECT w.word, f.form FROM ways w JOIN forms f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN ways w ON w.word = f.word
WHERE NOT EXISTS (SELECT 1 FROM forms g WHERE g.word = w.root AND g.form IS NOT NULL)"""


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def licence_places(base: dict[str, str]) -> str:
    """Words of each document and the places of the base phrases."""
    phrases = ", ".join(f"({phrase.split()!r}, '{label}')" for phrase, label in base.items())
    return f"""WITH cut AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
places AS (
    SELECT doc_id, label, spot - 1 AS place
    FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS spot FROM cut), (VALUES {phrases}) p(phrase, label)
    WHERE words[spot] = phrase[1] AND words[spot : spot + len(phrase) - 1] = phrase)
SELECT c.doc_id, len(any_value(c.words))::BIGINT AS n_words, count(label)::BIGINT AS n_base, min(place)::BIGINT AS first_word,
       max(place)::BIGINT AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM cut c LEFT JOIN places p USING (doc_id) GROUP BY c.doc_id"""


def nearest_ids(every: int = 50, k: int = 5) -> str:
    """The nearest rows of each query by exact cosines."""
    return f"""WITH usable AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) > 0),
sized AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM usable),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_dot_product(q.v, c.v) / (q.size * c.size) AS score
    FROM sized q JOIN sized c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id::BIGINT AS query_id, rank::INT AS rank, vec_id::BIGINT AS vec_id, round(score, 9) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM scored) WHERE rank <= {k}"""


def edits() -> str:
    """Each text with its last quarter replaced by the beginning of the next one."""
    return """WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
           coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following
    FROM documents)
SELECT doc_id, n::BIGINT AS n_chars,
       sha256(substr(text, 1, n - n // 4) || substr(following, 1, n // 4)) AS edited_sha256
FROM texts"""


def near_duplicates(share: int = 75) -> str:
    """Shingle sets, all links between different sets, and the smallest document that links lead to."""
    return f"""WITH RECURSIVE cut AS (
    SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM cut)),
coded AS (SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM shingles),
sets AS (SELECT doc_id, list(s ORDER BY s) AS whole, count(*) AS n FROM coded GROUP BY doc_id),
classes AS (SELECT min(doc_id) AS c, whole, any_value(n) AS n FROM sets GROUP BY whole),
members AS (SELECT c, n, unnest(whole) AS s FROM classes),
pairs AS (SELECT a.c AS a, b.c AS b FROM members a JOIN members b ON a.s = b.s AND a.c < b.c
    GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {share} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reached AS (SELECT c AS a, c AS b FROM classes UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
roots AS (SELECT a AS c, min(b) AS component FROM reached GROUP BY a),
placed AS (SELECT s.doc_id, s.n, r.component FROM sets s JOIN classes c USING (whole) JOIN roots r USING (c))
SELECT d.doc_id, coalesce(p.n, 0)::BIGINT AS n_shingles, coalesce(p.component, d.doc_id) AS component_id,
       coalesce(p.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN placed p USING (doc_id)"""


def repeated_strings(length: int = 400) -> str:
    """Every string of ``length`` bytes of every text, counted; bytes under those that start twice go."""
    return f"""WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS s
    FROM (SELECT doc_id, h, unnest(range(0, n - {length} + 1)) AS i FROM texts WHERE n >= {length})),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM starts) WHERE c > 1),
runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh FROM again)),
spans AS (SELECT doc_id, run, min(i) AS low, max(i) + {length} AS high FROM runs GROUP BY doc_id, run),
kept AS (
    SELECT s.doc_id, sum(high - low) AS gone, count(*) AS spans,
           string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) || any_value(substr(h, 2 * last + 1)) AS rest
    FROM (SELECT *, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before, max(high) OVER (PARTITION BY doc_id) AS last
          FROM spans) s JOIN texts USING (doc_id) GROUP BY s.doc_id)
SELECT t.doc_id, t.n::BIGINT AS n_bytes, coalesce(k.gone, 0)::BIGINT AS n_removed, coalesce(k.spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(k.rest, t.h))) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)"""
