"""Byte-pair encoding of whole texts through a trie of their distinct words, and decoding.

The text is cut into words by the vocabulary's pattern. A byte-pair encoding has
two properties: every prefix of its tokens is the encoding of the bytes they cover,
and a token sequence is an encoding if each neighbouring pair is one. So the
encoding of a prefix is known from its last token alone. The distinct words of a
batch, in byte order, are a depth-first walk through their trie: the last tokens
along the path are a stack, and a word continues from the prefix it shares with the
word before it, whose states were computed once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millwright.llm.stored import in_batches, schema_with

#: Fixed value: the pattern that cuts text into words; white space is Unicode's property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words and pairs remembered by a Python worker between batches; beyond it they are computed anew.
REMEMBERED = 300_000
GROUP_CHARS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        spelled = lambda word: bytes(letters[c] for c in word)
        self.ids = {spelled(word): i for word, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        added = set(self.special.values())
        self.bytes_of = {i: word for word, i in self.ids.items() if i not in added}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.ids[spelled(left)], self.ids[spelled(right)]] = rank
        self.merged = {
            pair: self.ids[self.bytes_of[pair[0]] + self.bytes_of[pair[1]]] for pair in self.ranks
        }
        reachable = set(self.merged.values()) | {i for word, i in self.ids.items() if len(word) == 1}
        self.suffixes = {word: i for word, i in self.ids.items() if i in reachable}
        self.longest = max(map(len, self.suffixes))
        self.cut = regex.compile(PATTERN).findall
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(names)})").split if names else self.unsplit
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    @staticmethod
    def unsplit(text: str) -> list[str]:
        """A text as one part: special tokens in it are ordinary text."""
        return [text]

    def merge(self, word: bytes) -> list[int]:
        """The encoding of a short word straight from the merge ranks; decides on pairs."""
        ids = [self.ids[word[i : i + 1]] for i in range(len(word))]
        while len(ids) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 60:
                break
            best, out, i = (ids[at], ids[at + 1]), [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == best:
                    out.append(self.merged[best])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, one after the other, are their own encoding."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        found = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        self.pairs[left << 32 | right] = found
        return found

    def learn(self, texts: list[str]) -> None:
        """Add the encodings of words not yet known, in one walk through their trie."""
        suffixes, pairs, fits, longest, bytes_of = self.suffixes, self.pairs, self.fits, self.longest, self.bytes_of
        last: list[int] = [-1]  # last token of each prefix on the path; the root has none
        before = b""
        for word, text in sorted((text.encode(), text) for text in texts):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = suffixes.get(word[start:end])
                    if token is None:
                        continue
                    if start == 0:
                        break
                    good = pairs.get(last[start] << 32 | token)
                    if good is None:
                        good = fits(last[start], token)
                    if good:
                        break
                last.append(token)
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end -= len(bytes_of[last[end]])
            self.known[text] = np.array(ids[::-1], "<u4").tobytes()
            before = word

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; broken UTF-8 becomes replacement characters, specials keep their spelling."""
        special = set(self.special.values())
        if special.isdisjoint(np.unique(ids).tolist()):
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        runs = groupby(ids.tolist(), lambda i: i if i in special else -1)
        return "".join(
            b"".join(map(self.bytes_of.__getitem__, run)).decode("utf-8", "replace") for _, run in runs
        )


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each Python worker and file."""
    return Vocabulary(path)


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Consecutive texts, about ``most`` characters at a time."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def encoded(vocab: Vocabulary, texts: list[str], plain_specials: bool = False) -> Iterator[bytes]:
    """The ids of each text; words are met once for a group of texts."""
    split, special = (vocab.unsplit, {}) if plain_specials else (vocab.split, vocab.special)
    for group in groups(texts):
        cut = [[part if part in special else vocab.cut(part) for part in split(t) if part] for t in group]
        distinct = set(chain.from_iterable(part for parts in cut for part in parts if isinstance(part, list)))
        if len(vocab.known) > REMEMBERED:
            vocab.known.clear()
        vocab.learn([word for word in distinct if word not in vocab.known])
        for parts in cut:
            yield b"".join(
                b"".join(map(vocab.known.__getitem__, part)) if isinstance(part, list)
                else np.array([special[part]], "<u4").tobytes()
                for part in parts
            )


def encode_texts(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", plain_specials: bool = False
) -> DataFrame:
    """Add the token ids of each whole text, as bytes of little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids; a text of any length is encoded whole.
    Repeated rows are encoded each. With ``plain_specials`` the spelling of a special
    token is ordinary text. Columns named ``ids`` must not exist yet.
    """
    if ids in docs.columns:
        raise ValueError(f"there is a column {ids!r} already")

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            column = pa.array(encoded(vocab, texts, plain_specials), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, ids])

    return in_batches(docs, run, schema_with(docs, f"{ids} binary"))


def encode_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: each text encoded, and its ids decoded again.

    A null text counts as empty: no tokens, digests of nothing. Repeated rows give
    repeated results, a null key stays null, other columns are not read.
    """
    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, firsts, seconds = [], [], []
            for ids in encoded(vocab, texts):
                counts.append(len(ids) // 4)
                firsts.append(hashlib.sha256(ids).hexdigest())
                decoded = vocab.decode(np.frombuffer(ids, "<u4")).encode("utf-8")
                seconds.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(firsts, pa.string()), pa.array(seconds, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    slim = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return in_batches(slim, run, schema).withColumnRenamed("key", key)
