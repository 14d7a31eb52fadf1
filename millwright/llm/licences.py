"""Licence notices by a positional index of rare words, all in DataFrame functions.

Each whole text is cut into words once. A hit is a place of a licence word (a word of the
templates that is no function word), kept with the few words around it. The document
counts of the licence words over the whole corpus give their weights. The index is one map from a
word to its postings, (template, place in it), so a hit costs its word's postings, however many
templates there are. A key phrase has postings for its two rarest words; the starts they
give (file place minus template place) must meet, and each such start is verified word by word. Without a
verified phrase a file's rarest licence words vote for (template, start) by weight.
Nothing is shuffled but the word counts, and the texts if few splits hold most of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from millwright.llm.stored import written
from millwright.session import spread

# Characters that make words, phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same, character by character: Java looks these up in one table. It joins ranges by nested objects,
#: on which eight threads of one JVM took seven times the CPU seconds of one.
LISTED_WORD = "[^" + "".join(rf"\x{c:02X}" for c in range(0x80) if not chr(c).isalnum()) + "]+"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
FUNCTION_WORDS = "a and any are as by for from in into is may not of or the this to with without under you".split()
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A notice; its key phrase must stand in a file word for word."""

    label: str
    phrase: str
    notice: str
    base: bool = False

    @property
    def key(self) -> list[str]:
        return self.phrase.split()

    @property
    def rare(self) -> list[str]:
        return sorted(set(self.notice.split()) - set(FUNCTION_WORDS))


TEMPLATES = [Template(label, phrase, phrase, True) for phrase, label in BASE.items()] + [
    Template("apache-2.0", "apache license version 2 0",
             "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    Template("gpl-2.0", "gnu general public license version 2",
             "redistribute it and or modify it under the terms of the gnu general public license version 2 "
             "as published by the free software foundation"),
    Template("gpl-3.0", "gnu general public license version 3",
             "redistribute it and or modify it under the terms of the gnu general public license version 3 "
             "as published by the free software foundation"),
    Template("lgpl", "gnu lesser general public license",
             "redistribute it and or modify it under the terms of the gnu lesser general public license "
             "as published by the free software foundation"),
    Template("cc-by-nc", "cc by nc", "this work is licensed under cc by nc 4 0 for non commercial use"),
    Template("cc-by-sa", "cc by sa", "this work is licensed under cc by sa 4 0 share alike"),
    Template("mpl", "mozilla public license",
             "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("mit", "permission is hereby granted free of charge",
             "permission is hereby granted free of charge to any person obtaining a copy of this software "
             "and associated documentation files to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms",
             "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met"),
    Template("unlicense", "unencumbered software released into the public domain",
             "this is free and unencumbered software released into the public domain"),
]
#: A file's licence words that vote for a notice, the rarest ones.
TOP_WORDS = 8
#: Template and place as one number.
SHIFT = 1 << 32


def licence_hits(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, hits``: for each licence word its place, itself, the words around and its place there."""
    vocabulary = sorted({w for t in templates for w in t.rare})
    reach = max(len(t.key) for t in templates) - 1
    whole = spread(docs.select("doc_id", "text"))
    cut = whole.select("doc_id", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LISTED_WORD), 0).alias("words"))
    found = F.filter(
        F.transform("words", lambda w, i: F.when(F.lower(w).isin(*vocabulary), i)), lambda i: i.isNotNull()
    )
    around = lambda i: F.transform(
        F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + reach + 1),
        lambda w: F.translate(w, UPPER, LOWERED),
    )
    hits = F.transform(found, lambda i: F.struct(
        i.alias("place"),
        F.translate(F.get("words", i), UPPER, LOWERED).alias("word"),
        around(i).alias("around"),
        F.least(i, F.lit(reach)).alias("at"),
    ))
    return cut.select("doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))


def word_weights(hits: DataFrame) -> dict[str, float]:
    """Inverse document frequency of each licence word that occurs, over all documents."""
    per_word = (
        hits.select(F.explode(F.array_union(F.array_distinct("hits.word"), F.array(F.lit("")))).alias("word"))
        .groupBy("word").count().collect()
    )
    # The empty word stands for every document; there are no more rows than licence words.
    counts = {r["word"]: r["count"] for r in per_word}
    total = counts.pop("", 0)
    return {w: math.log((total + 1) / (n + 0.5)) for w, n in counts.items()}


def ranked_key(template: Template, weights: dict[str, float]) -> list[str]:
    """The words of a key phrase, rarest first."""
    unseen = max(weights.values(), default=0.0) + 1.0
    return sorted({w for w in template.key if w not in FUNCTION_WORDS}, key=lambda w: (-weights.get(w, unseen), w))


def postings(entries: dict[str, list[Column]], kind: str) -> Column:
    """A map from a word to its entries, as one constant."""
    if not entries:
        return F.create_map().cast(f"map<string,array<{kind}>>")
    pairs = [cell for word, own in sorted(entries.items()) for cell in (F.lit(word), F.array(*own))]
    return F.create_map(*pairs)


def looked_up_in(index: Column, word: Column, kind: str) -> Column:
    return F.coalesce(F.try_element_at(index, word), F.array().cast(f"array<{kind}>"))


def code(template: Column, start: Column) -> Column:
    """Template and start as one number, in the order of templates, then starts (which may lie before the text)."""
    return template.cast("long") * SHIFT + start.cast("long") + SHIFT // 2


def key_starts(templates: list[Template], weights: dict[str, float]) -> Column:
    """Codes of all verified key phrases, as an array."""
    firsts: dict[str, list[Column]] = {}
    seconds: dict[str, list[Column]] = {}
    for i, t in enumerate(templates):
        ranked = ranked_key(t, weights)
        entry = F.struct(
            F.lit(i).alias("t"), F.lit(t.key.index(ranked[0])).alias("p"), F.lit(len(t.key)).alias("n"), F.lit(len(ranked) == 1).alias("alone")
        )
        firsts.setdefault(ranked[0], []).append(entry)
        if len(ranked) > 1:
            seconds.setdefault(ranked[1], []).append(F.struct(F.lit(i).alias("t"), F.lit(t.key.index(ranked[1])).alias("p")))
    phrases = F.array(*[F.lit(t.phrase) for t in templates])
    kinds = "struct<t:int,p:int,n:int,alone:boolean>", "struct<t:int,p:int>"
    first, second = postings(firsts, kinds[0]), postings(seconds, kinds[1])

    def begun(h: Column) -> Column:
        return F.transform(looked_up_in(first, h["word"], kinds[0]), lambda e: F.struct(
            code(e["t"], h["place"] - e["p"]).alias("code"), e["alone"].alias("alone"),
            ((h["at"] >= e["p"]) & (F.concat_ws(" ", F.slice(h["around"], F.greatest(h["at"] - e["p"], F.lit(0)) + 1, e["n"])) == F.get(phrases, e["t"])))
            .alias("spelled"),
        ))

    starts = F.filter(F.flatten(F.transform("hits", begun)), lambda c: c["spelled"])
    met = F.flatten(F.transform("hits", lambda h: F.transform(
        looked_up_in(second, h["word"], kinds[1]), lambda e: code(e["t"], h["place"] - e["p"])
    )))
    coded = lambda alone: F.transform(F.filter(starts, lambda c: c["alone"] == alone), lambda c: c["code"])
    return F.concat(coded(True), F.array_intersect(coded(False), met))


def notice_votes(templates: list[Template], weights: dict[str, float]) -> Column:
    """The largest share of a notice's weight that a file's rarest licence words give to one start of it, 0 to 1."""
    unseen = max(weights.values(), default=0.0) + 1.0
    value = lambda w: max(weights.get(w, unseen), 1e-6)
    index: dict[str, list[Column]] = {}
    for i, t in enumerate(templates):
        total = sum(value(w) for w in t.notice.split() if w in t.rare)
        for p, w in enumerate(t.notice.split()):
            if w in t.rare:
                index.setdefault(w, []).append(F.struct(F.lit(i).alias("t"), F.lit(p).alias("p"), F.lit(value(w) / total).alias("v")))
    kind = "struct<t:int,p:int,v:double>"
    places = postings(index, kind)
    rank = F.create_map(*[c for j, w in enumerate(sorted(index, key=lambda w: (-value(w), w))) for c in (F.lit(w), F.lit(j))])
    ranks = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.try_element_at(rank, h["word"]))))
    least = F.coalesce(F.get(ranks, F.lit(TOP_WORDS - 1)), F.lit(len(index)))
    top = F.filter("hits", lambda h: F.try_element_at(rank, h["word"]) <= least)
    votes = F.array_sort(F.flatten(F.transform(top, lambda h: F.transform(
        looked_up_in(places, h["word"], kind), lambda e: F.struct(code(e["t"], h["place"] - e["p"]).alias("code"), e["v"].alias("v"))
    ))))
    none = F.struct(F.lit(-1).cast("long").alias("code"), F.lit(0.0).alias("run"), F.lit(0.0).alias("best"))

    def add(held: Column, vote: Column) -> Column:
        run = F.when(held["code"] == vote["code"], held["run"]).otherwise(0.0) + vote["v"]
        return F.struct(vote["code"].alias("code"), run.alias("run"), F.greatest(held["best"], run).alias("best"))

    return F.least(F.aggregate(votes, none, add)["best"], F.lit(1.0))


def scan_licences(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every document.

    The score is 1 with a verified key phrase; else half the largest share, by weight, of
    a notice's licence words that stand where the notice has them, among the ``TOP_WORDS`` rarest
    licence words of the file. A null text counts as empty: no words, no
    labels (empty strings), score 0. Repeated rows give repeated results; an empty table
    gives no rows.
    """
    hits = written(licence_hits(docs, templates), "licence-hits")
    weights = word_weights(hits)
    found = hits.select(
        "doc_id", "n_words", key_starts(templates, weights).alias("_keys"), notice_votes(templates, weights).alias("_votes")
    )
    template = lambda c: F.floor(c / SHIFT).cast("int")
    base = F.array(*[F.lit(t.base) for t in templates])
    names = F.array(*[F.lit(t.label) for t in templates])
    based = F.filter("_keys", lambda c: F.get(base, template(c)))
    places = F.transform(based, lambda c: F.pmod(c, F.lit(SHIFT)) - SHIFT // 2)
    listed = lambda codes: F.array_join(F.array_sort(F.array_distinct(F.transform(codes, lambda c: F.get(names, template(c))))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(based).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        listed(based).alias("base_labels"),
        listed("_keys").alias("labels"),
        F.when(F.size("_keys") > 0, 1.0).otherwise(0.5 * F.col("_votes")).alias("score"),
    )
