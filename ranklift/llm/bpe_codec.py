"""BPE encoding and decoding with batched numpy merge rounds.

The vocabulary file (a parameter) is read once on the driver; its pair table, a sorted
array of pair keys with ranks and merged ids, goes to the tasks.  A task collects the
distinct new words of a slice of texts, lays the symbols of all of them into one flat
array, and merges in rounds: binary search finds every adjacent pair's rank, each word
takes its lowest rank, and all its leftmost non-overlapping occurrences merge at once.
Words are remembered up to ``MEMORY`` entries per task.

Text steps as in the file: special strings are taken out of the raw text first; the rest
is put into NFC, white space runs become one space, letters become lower case, the split
pattern yields words, and their UTF-8 bytes become symbols, the last one with the word
end mark.  Decoding joins the tokens' strings with one space.

Defined results: null text counts as empty and gives no ids; repeated rows are each
encoded; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from ranklift.llm.catalog import register
from ranklift.llm.common import table

MEMORY = 400_000
SLICE_CHARS = 2_000_000


def byte_symbols() -> list[str]:
    """Printable character for each byte: itself if it is visible Latin-1, else the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


@dataclass(frozen=True)
class Vocabulary:
    tokens: list[str]
    specials: dict[str, int]
    pattern: str
    inner: np.ndarray  # byte -> id
    final: np.ndarray  # byte -> id with the word end mark
    keys: np.ndarray   # sorted left * 2**32 + right
    ranks: np.ndarray
    merged: np.ndarray


def load(path: str) -> Vocabulary:
    """Vocabulary of a tokenizer file whose model is BPE over bytes with a word end mark."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    ids = dict(model["vocab"])
    specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    tokens = [""] * (max([*ids.values(), *specials.values()]) + 1)
    for t, i in [*ids.items(), *specials.items()]:
        tokens[i] = t
    pairs = [(p.split(" ") if isinstance(p, str) else p) for p in model["merges"]]
    keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
    order = np.argsort(keys)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    sym = byte_symbols()
    return Vocabulary(tokens, specials, split["pattern"]["Regex"], np.array([ids[s] for s in sym], np.int64),
                      np.array([ids[s + end] for s in sym], np.int64), keys[order], order.astype(np.int64),
                      np.array([ids[a + b] for a, b in pairs], np.int64)[order])


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) of the given non-empty words."""
    flat = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    ids = v.inner[flat]
    ids[ends - 1] = v.final[flat[ends - 1]]
    word = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    active = np.arange(len(ids))  # positions of the symbols of words that may still merge
    done_ids, done_word, done_at = [], [], []
    none = np.int64(1) << 40
    while len(ids) > 1:
        same = word[:-1] == word[1:]
        key = (ids[:-1] << 32) | ids[1:]
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        rank = np.where(same & (v.keys[at] == key), v.ranks[at], none)
        starts = np.flatnonzero(np.r_[True, ~same])
        best = np.minimum.reduceat(np.r_[rank, none], starts)
        local = np.cumsum(np.r_[0, ~same])  # running number of the word
        settled = (best == none)[local]
        if settled.any():
            done_ids.append(ids[settled])
            done_word.append(word[settled])
            done_at.append(active[settled])
        hit = np.flatnonzero((rank == best[local[:-1]]) & (rank < none))
        if not len(hit):
            ids = ids[:0]
            break
        run = np.r_[True, np.diff(hit) != 1]
        first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - first) % 2 == 0]  # of overlapping pairs every other one, from the left
        ids[hit] = v.merged[at[hit]]
        keep = ~settled
        keep[hit + 1] = False
        ids, word, active = ids[keep], word[keep], active[keep]
    if len(ids):
        done_ids.append(ids)
        done_word.append(word)
        done_at.append(active)
    out, w = np.concatenate(done_ids), np.concatenate(done_word)
    order = np.argsort(np.concatenate(done_at), kind="stable")
    return out[order], np.searchsorted(w[order], np.arange(len(words) + 1))


class Codec:
    """Word memory and the text steps around ``merge_words``, for use inside a task."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.words = regex.compile(v.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, v.specials)) + ")") if v.specials else None
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # sigma has one lower-case form here, wherever it stands in a word
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def split(self, text: str) -> list[str]:
        """Words of a text; a special string stands as itself behind a NUL."""
        if self.special is None or not self.special.search(text):
            return self.words.findall(self.normal(text))
        out = []
        for i, part in enumerate(self.special.split(text)):
            out.extend(["\0" + part] if i % 2 else self.words.findall(self.normal(part)))
        return out

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.ids) > MEMORY:
            self.ids.clear()
            self.decoded.clear()
        new = sorted(set().union(*texts) - self.ids.keys())
        marks = [w for w in new if w[0] == "\0" and w[1:] in self.v.specials]
        for w in marks:
            self.ids[w] = np.array([self.v.specials[w[1:]]], "<u4").tobytes()
            self.decoded[w] = w[1:]
        new = [w for w in new if w not in self.ids]
        if not new:
            return
        flat, off = merge_words([w.encode("utf-8") for w in new], self.v)
        little, tokens = flat.astype("<u4"), self.v.tokens
        for i, w in enumerate(new):
            a, b = off[i], off[i + 1]
            self.ids[w] = little[a:b].tobytes()
            self.decoded[w] = " ".join([tokens[x] for x in flat[a:b]])

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) for each text."""
        split = [self.split(t) for t in texts]
        self.learn(split)
        for words in split:
            yield b"".join(map(self.ids.__getitem__, words)), " ".join(map(self.decoded.__getitem__, words))


def slices(texts: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about ``limit`` bytes."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    a, total = 0, 0
    for i, n in enumerate(size):
        total += int(n)
        if total >= limit or i == len(size) - 1:
            yield a, [t or "" for t in texts.slice(a, i + 1 - a).to_pylist()]
            a, total = i + 1, 0


def _runner(v, key: str, text: str, row):
    def run(batches):
        codec = Codec(v.value)
        for b in batches:
            ids = b.column(key)
            for a, texts in slices(b.column(text)):
                out = [row(*x) for x in codec.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, len(texts)), *[pa.array(c) for c in zip(*out, strict=True)]],
                    names=[key, *[f"c{i}" for i in range(len(out[0]))]])
    return run


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, token_ids, decoded) of every text."""
    v = docs.sparkSession.sparkContext.broadcast(load(path))
    row = lambda ids, decoded: (np.frombuffer(ids, "<u4").astype(np.int32), decoded)
    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(
        _runner(v, key, text, row), f"`{key}` {kind}, c0 array<int>, c1 string").toDF(key, "token_ids", "decoded")


def token_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every text; ids and texts stay in the tasks."""
    v = docs.sparkSession.sparkContext.broadcast(load(path))

    def row(ids, decoded):
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(
        _runner(v, key, text, row), f"`{key}` {kind}, c0 long, c1 string, c2 string").toDF(
        key, "n_tokens", "ids_sha256", "decoded_sha256")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op9_bpe_codec")
def op9_bpe_codec(spark, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), default_path())
