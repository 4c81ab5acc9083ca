"""Byte-pair encoding of words in batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of
every adjacent pair by binary search over sorted pair keys, takes the lowest
rank of each word, joins all its places from left to right and closes the
gaps; words without a known pair leave. Merging all places of a word's lowest
rank at once gives what merging one place after the other gives, because a
merge only makes pairs of higher rank, which is checked when the vocabulary is
read.
"""

from __future__ import annotations

import json
import re

import numpy as np
from tokenizers import Tokenizer


NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    shown = set(printable)
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Merge table, symbols and word pattern of a tokenizers file of kind BPE
    with word ends, as plain arrays (a few MB, shipped with each task)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"]:
            raise ValueError("a BPE vocabulary with word ends is needed")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        #: The same normaliser and word pattern without the vocabulary, for rare characters.
        self.splitter = json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {s: i for i, s in enumerate(byte_symbols())}, "merges": []}})
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.width = np.int64(max(vocab.values()) + 1)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        born = np.full(int(self.width), -1, np.int64)
        born[made] = np.arange(len(made))
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any() or len(set(made.tolist())) < len(made):
            raise ValueError("merges are not in order of their parts")

    @property
    def size(self) -> int:
        return max(self.tokens) + 1


def pair_ranks(v: Vocabulary, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    key = a * v.width + b
    at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
    return np.where(v.keys[at] == key, v.ranks[at], NONE)


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids of each word)."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    sym = v.inner[flat]
    ends = np.cumsum(lens)
    sym[ends[lens > 0] - 1] = v.final[flat[ends[lens > 0] - 1]]
    word = np.repeat(np.arange(len(words)), lens)
    done_word, done_sym, done_at = [], [], []
    at = np.arange(len(sym))  # place in the input, which orders the ids again at the end
    rank = np.full(len(sym), NONE)  # of the pair that starts here
    if len(sym) > 1:
        rank[:-1] = np.where(word[1:] == word[:-1], pair_ranks(v, sym[:-1], sym[1:]), NONE)
    while len(sym):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        low = np.minimum.reduceat(rank, first)
        live = np.repeat(low < NONE, np.diff(np.r_[first, len(sym)]))
        if not live.all():
            done_word.append(word[~live]), done_sym.append(sym[~live]), done_at.append(at[~live])
            sym, word, at, rank = sym[live], word[live], at[live], rank[live]
            if not len(sym):
                break
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = low[low < NONE]
        hit = np.flatnonzero(rank == np.repeat(low, np.diff(np.r_[first, len(sym)])))
        # Of overlapping places (aaa) every second one counts, from the left.
        fresh = np.r_[True, np.diff(hit) != 1]
        run = np.arange(len(hit)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        hit = hit[run % 2 == 0]
        sym[hit] = v.made[rank[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        new = np.cumsum(keep) - 1
        sym, word, at, rank = sym[keep], word[keep], at[keep], rank[keep]
        hit = new[hit]
        touched = np.zeros(len(sym), bool)
        touched[hit], touched[hit[hit > 0] - 1] = True, True
        near = np.flatnonzero(touched)
        near_in = near[near + 1 < len(sym)]
        rank[near] = NONE
        rank[near_in] = np.where(word[near_in + 1] == word[near_in], pair_ranks(v, sym[near_in], sym[near_in + 1]), NONE)
    if not done_at:
        return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    order = np.argsort(np.concatenate(done_at), kind="stable")
    return np.concatenate(done_sym)[order], np.bincount(np.concatenate(done_word), minlength=len(words))


#: Texts of these characters alone are cut into words by PLAIN; whatever holds
#: another one (from U+0180, two lower-cased ones, control strings) goes chunk
#: by chunk through the library's own normaliser and pattern.
ODD = re.compile(rb"[\xc6-\xff\x00\x01]|\xc4\xb0|<\|")
HOLE, STOP = "\x00", "\x01"
LETTER, NUMBER = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
PLAIN = re.compile(f"{HOLE}|{STOP}|'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{HOLE}{STOP}\t-\r \x85\xa0{LETTER}{NUMBER}]+")


def gather(flat: np.ndarray, start: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """flat[start[c] : start[c] + counts[c]] for all codes, joined."""
    n = counts[codes]
    ends = np.cumsum(n)
    if not len(codes) or not ends[-1]:
        return flat[:0]
    return flat[np.repeat(start[codes] - ends + n, n) + np.arange(ends[-1])]


class Codes(dict):
    """Numbers in order of first sight; ``new`` lists the keys not yet encoded."""

    def __init__(self, start):
        super().__init__(start)
        self.new: list = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n


class Encoder:
    """Ids of whole texts. Each different word is merged once and kept; the
    store is emptied beyond ``limit`` words, which bounds memory and changes no
    id."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 250_000):
        self.v, self.limit = vocabulary, limit
        split = Tokenizer.from_str(vocabulary.splitter)
        self.normal, self.cut = split.normalizer, split.pre_tokenizer
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")")
        self.clear()

    def clear(self) -> None:
        self.index = Codes({HOLE: 0, STOP: 1})
        self.flat, self.start, self.counts = np.zeros(0, np.int32), np.zeros(2, np.int64), np.zeros(2, np.int64)

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids of the newest keys, in order of their codes."""
        self.index.new.clear()
        self.start = np.r_[self.start, len(self.flat) + np.cumsum(counts) - counts]
        self.counts = np.r_[self.counts, counts]
        self.flat = np.r_[self.flat, ids.astype(np.int32)]

    def odd_ids(self, chunk: bytes) -> list[int]:
        out: list[int] = []
        for part in self.special.split(chunk.decode("utf-8", "replace")):
            if part in self.v.special:
                out.append(self.v.special[part])
            elif part:
                words = [bytes(self.byte[s] for s in w) for w, _ in self.cut.pre_tokenize_str(self.normal.normalize_str(part))]
                out += merge_words(self.v, words)[0].tolist()
        return out

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        holes: list[bytes] = []
        fill = HOLE.encode()
        plain = [b" ".join([(holes.append(c) or fill) if ODD.search(c) else c for c in t.split()]) if ODD.search(t) else t for t in texts]
        whole = f" {STOP} ".encode().join(plain)
        words = PLAIN.findall(whole.decode("utf-8", "replace").lower())
        if len(self.index) > self.limit:
            self.clear()
        codes = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            self.add(*merge_words(self.v, [w.encode() for w in self.index.new]))
        inner = np.fromiter(map(self.index.__getitem__, holes), np.int64, len(holes))
        if self.index.new:
            per = [self.odd_ids(c) for c in self.index.new]
            self.add(np.array([i for p in per for i in p], np.int64), np.array([len(p) for p in per], np.int64))
        owner = np.cumsum(codes == 1)
        codes[codes == 0] = inner
        per = np.bincount(owner, weights=self.counts[codes], minlength=len(texts)).astype(np.int64) if len(codes) else np.zeros(len(texts), np.int64)
        return gather(self.flat, self.start, self.counts, codes), per
