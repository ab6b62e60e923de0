"""Exact token counts of every prefix, by dynamic programming.

A sequence of tokens is what the merges give exactly when each token is what its own
text gives and every adjacent pair is stable: no merge could have crossed the border
between the two. So the last token of a prefix is the one token that ends there and is
stable after the last token of the prefix before it, and its count is one more than
that prefix has. One pass over a word gives the count of each of its prefixes; a
prefix that is taken for a word of its own ends in a token of the end of a word.

Words never merge with each other, so the counts of a text are those of its words, one
after the other, and each distinct word is worked out once. All new words of a chunk are
worked out together with numpy, a byte of each at a time; an automaton says which
tokens end at a byte.

Whoever has the counts of a text can cut it to a budget or tell what a part costs without
encoding it again. The vocabulary must be a BPE file of the tokenizers library whose
words end in a suffix, lower case, with white space dropped.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE_ENTRIES, CHUNK_CHARS, FAR, Lookup, Recent, byte_letters
from .common import lean

#: The normalizers, the cut into words, and white space as the vocabulary's file has them.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters that are one character in lower case and never composed with others.
LATIN, SPACE = "A-Za-zÀ-ÖØ-öø-įı-ɏ", r"\t-\r "
#: A word with the white space before it, in texts of ASCII and Latin letters.
WORD = re.compile(rf"[{SPACE}]*(?:'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[{LATIN}]+|[0-9]|[^{SPACE}0-9{LATIN}]+)|[{SPACE}]+")
ODD = re.compile(rf"[^\x00-\x7F{LATIN}]")
PART = re.compile(rf"[{WHITE}]+|[^{WHITE}]+")
#: Pairs of tokens of which a worker keeps whether they are stable (a power of two).
PAIRS = 1 << 20


@lru_cache(maxsize=1)
def composing() -> frozenset[str]:
    """Characters without a combining class that may still be composed with the one before."""
    second = {chr(c) for c in chain(range(0x1161, 0x1176), range(0x11A8, 0x11C3))}  # vowels and ends of Hangul syllables
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(chr(int(parts[1], 16)))
    return frozenset(second)


def segments(text: str) -> Iterator[str]:
    """The text cut where normalisation never reaches across."""
    at, joins = 0, composing()
    for k, c in enumerate(text):
        if k and not unicodedata.combining(c) and c not in joins:
            yield text[at:k]
            at = k
    yield text[at:]


class PrefixCounter:
    """Counts of all prefixes over one vocabulary file."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        spec = json.loads(open(path, encoding="utf-8").read())
        model, before = spec["model"], spec["pre_tokenizer"]["pretokenizers"] if spec["pre_tokenizer"]["type"] == "Sequence" else []
        normal = spec["normalizer"]["normalizers"] if spec["normalizer"] and spec["normalizer"]["type"] == "Sequence" else []
        cut = len(before) == 2 and before[0]["type"] == "Split" and before[0]["pattern"] == {"Regex": WORDS} and before[0]["behavior"] == "Removed" and before[0]["invert"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or normal != NORMALIZERS or not cut or before[1]["type"] != "ByteLevel" or before[1]["use_regex"] or before[1]["add_prefix_space"]:
            raise ValueError(f"{path} is no BPE file of lower-case words that end in a suffix")
        library = Tokenizer.from_file(path)
        self.normal, self.pre = library.normalizer, library.pre_tokenizer
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        self.born = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(tuple(m) if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            ranks[x * self.size + y] = rank
            if self.born[z] < 0:
                self.born[z], self.left[z], self.right[z] = rank, x, y
        self.ranks = Lookup(np.array(list(ranks), np.int64), np.array(list(ranks.values()), np.int64))
        made = np.flatnonzero(self.born >= 0)
        own = np.ones(self.size, bool)  # tokens whose own text the merges turn into just that token
        own[made] = self._stable(self.left[made], self.right[made], self.born[made])
        for t in made[np.argsort(self.born[made])]:
            own[t] &= own[self.left[t]] & own[self.right[t]]
        letters, tokens = byte_letters(), {}
        for t, i in vocab.items():
            if own[i]:  # its bytes: the token within a word, and the one at a word's end
                tokens.setdefault(bytes(letters[c] for c in t.removesuffix(suffix)), [-1, -1])[t.endswith(suffix)] = i
        self._automaton(tokens)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special, self.split = special, re.compile("|".join(map(re.escape, special))) if special else None
        self.pairs, self.verdicts = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        self.known = Recent(cache_entries)

    def _stable(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of tokens a and b (before a rank, where given).

        Both are undone step by step, the younger first; a merge of what then stands at the
        border crosses it if it comes before the left one's end and not after the right one's.
        """
        x, y, ok = a.copy(), b.copy(), np.ones(len(a), bool)
        end_x, end_y = np.full(len(a), FAR) if before is None else before.copy(), np.full(len(a), FAR)
        live = np.arange(len(a))
        while len(live):
            rank = self.ranks.get(x[live] * self.size + y[live])
            crossed = (rank >= 0) & (rank < end_x[live]) & (rank <= end_y[live])
            ok[live[crossed]] = False
            live = live[~crossed]
            bx, by = self.born[x[live]], self.born[y[live]]
            live, bx, by = (v[(bx >= 0) | (by >= 0)] for v in (live, bx, by))
            undo_x = bx > by
            i, j = live[undo_x], live[~undo_x]
            end_x[i], x[i] = bx[undo_x], self.right[x[i]]
            end_y[j], y[j] = by[~undo_x], self.left[y[j]]
        return ok

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same for pairs that may have been asked for before."""
        keys = a * self.size + b
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIRS.bit_length() + 1)).astype(np.int64)
        new = np.flatnonzero(self.pairs[slot] != keys)
        out = self.verdicts[slot]
        if len(new):
            some, first, of = np.unique(keys[new], return_index=True, return_inverse=True)
            verdicts = self._stable(some // self.size, some % self.size)
            out[new] = verdicts[of]
            slot, at = np.unique(slot[new[first]], return_index=True)  # of several pairs in one slot, one stays
            self.pairs[slot], self.verdicts[slot] = some[at], verdicts[at]
        return out

    def _automaton(self, tokens: dict[bytes, list[int]]) -> None:
        """States are beginnings of tokens: the longest in which what was read ends."""
        edges: dict[int, int] = {}
        state_of, length = {b"": 0}, [0]
        for t in sorted(tokens, key=len):
            at = 0
            for k, c in enumerate(t):
                to = edges.setdefault(at << 8 | c, len(length))
                if to == len(length):
                    state_of[t[: k + 1]] = to
                    length.append(k + 1)
                at = to
        fail, top, after = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        pair = np.full((len(length), 2), -1, np.int64)
        for text, at in sorted(state_of.items(), key=lambda x: len(x[0])):
            if len(text) > 1:
                fail[at] = next(state_of[text[k:]] for k in range(1, len(text) + 1) if text[k:] in state_of)
            after[at] = top[fail[at]]  # the longest shorter token that ends here
            top[at] = after[at]
            if text in tokens:
                pair[at], top[at] = tokens[text], at
        self.go, self.fail, self.top, self.after, self.pair = Lookup(np.array(list(edges), np.int64), np.array(list(edges.values()), np.int64)), fail, top, after, pair
        self.length = np.array(length, np.int64)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        to = self.go.get(state << 8 | byte)
        left = np.flatnonzero(to < 0)
        while len(left):
            root = state[left] == 0
            to[left[root]] = 0
            left = left[~root]
            state[left] = self.fail[state[left]]
            to[left] = self.go.get(state[left] << 8 | byte[left])
            left = left[to[left] < 0]
        return to

    def prefixes(self, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each byte of some words (one after the other, each of at least one byte) the count of the prefix that it ends.

        ``last`` and ``count`` are of the prefix as a beginning of a longer word, with a
        place before each word; the result is of the prefix as a word of its own.
        """
        order = np.argsort(-size, kind="stable")
        start = (np.cumsum(size) - size)[order]
        cell = start + order + 1  # place of a word's first byte
        last, count, whole = (np.zeros(len(raw) + len(size), np.int64) for _ in range(3))
        state = np.zeros(len(size), np.int64)
        for j in range(1, int(size.max(initial=0)) + 1):
            n = int(np.searchsorted(-size[order], -j, "right"))  # words that are long enough
            at = cell[:n] + j - 1
            state = self._step(state[:n], raw[start[:n] + j - 1].astype(np.int64))
            for ends, into in ((0, count), (1, whole)):
                here, node = np.arange(n), self.top[state]
                while len(here):
                    token, long = self.pair[node, ends], self.length[node]
                    before = at[here] - long
                    good = (token >= 0) & (long == j)
                    ask = np.flatnonzero((token >= 0) & (long < j))
                    good[ask] = self.stable(last[before[ask]], token[ask])
                    done = here[good]
                    into[at[done]] = count[before[good]] + 1
                    if not ends:
                        last[at[done]] = token[good]
                    here, node = here[~good], self.after[node[~good]]
        first = np.zeros(len(whole), bool)
        first[np.sort(cell) - 1] = True
        return whole[~first]

    def words(self, words: list[str]) -> dict[str, bytes]:
        """The counts of all prefixes, by characters, of words that the pre-tokenizer has cut: arrays of 32 bits."""
        split = [w for w in words if len(w) > 1 and w[0] == "'" and w[1].isalpha()]  # contractions; their beginnings are two words
        all_ = list(dict.fromkeys(chain(words, (c for w in split for c in w[:2]))))
        coded = [w.encode() for w in all_]
        raw, size = np.frombuffer(b"".join(coded), np.uint8), np.fromiter(map(len, coded), np.int64, len(coded))
        counts = self.prefixes(raw, size)
        stops = np.cumsum(size)
        ends = np.ones(len(raw), bool)  # bytes that end a character
        ends[:-1] = raw[1:] & 0xC0 != 0x80
        chars = np.r_[0, np.cumsum(ends)[stops - 1]].tolist() if len(size) else [0]
        flat = counts[ends].astype("<i4").tobytes()
        out = {w: flat[4 * a : 4 * b] for w, a, b in zip(all_, chars, chars[1:])}
        for w in split:
            one, two = (np.frombuffer(out[c], "<i4")[-1] for c in w[:2])
            out[w] = np.array([one, one + two][: len(w) - 1], "<i4").tobytes() + out[w][-4:]
        return out

    def _pieces(self, text: str) -> list[tuple[int, int]]:
        return [span for _, span in self.pre.pre_tokenize_str(text)]

    def odd(self, part: str) -> list[int]:
        """The counts of a part without white space whose characters normalisation may change."""
        raw = list(segments(part))
        normal = {s: self.normal.normalize_str(s) for s in {s[:k] for s in raw for k in range(1, len(s) + 1)}}
        whole = "".join(normal[s] for s in raw)
        pieces = self._pieces(whole)
        known = self.words([whole[a:b] for a, b in pieces])
        at, counts, begin = 0, [0], [0] * (len(whole) + 1)  # begin: where the word of a character begins
        for a, b in pieces:
            counts += [counts[-1]] * (a + 1 - len(counts))
            base = counts[-1]
            counts += (np.frombuffer(known[whole[a:b]], "<i4") + base).tolist()
            begin[a + 1 : b + 1] = [a] * (b - a)
        counts += [counts[-1]] * (len(whole) + 1 - len(counts))
        out = []
        for s in raw:
            for k in range(1, len(s)):  # a prefix that parts what is composed
                start = begin[at] if at else 0
                some = whole[start:at] + normal[s[:k]]
                cut = [some[a:b] for a, b in self._pieces(some)]
                ends = self.words(cut)
                out.append(counts[start] + sum(int.from_bytes(ends[w][-4:], "little") for w in cut))
            at += len(normal[s])
            out.append(counts[at])
        return out

    def _keys(self, text: str) -> list[str]:
        """An ordinary text cut into what is looked up: words with the white space before them, and odd parts."""
        if text.isascii() or not ODD.search(text):
            return WORD.findall(text)
        return list(chain.from_iterable([p] if ODD.search(p) else WORD.findall(p) for p in PART.findall(text)))

    def _learn(self, keys: list[str]) -> None:
        """Work out the counts of new keys."""
        plain, known = {}, self.known.new
        for key in keys:
            if not ODD.search(key):
                plain[key] = key.lstrip("\t\n\x0b\x0c\r ").lower()
            elif PART.match(key)[0][0] in "\x85\xa0" or key.isspace():
                known[key] = bytes(4 * len(key))
            else:
                known[key] = array("i", self.odd(key)).tobytes()
        found = self.words([w for w in dict.fromkeys(plain.values()) if w])
        for key, word in plain.items():
            known[key] = bytes(4 * (len(key) - len(word))) + found.get(word, b"")

    def counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text the token counts of its prefixes from no character to all."""
        at = 0
        while at < len(texts):
            self.known.turn()
            cut, size, missing = [], 0, {}
            while at < len(texts) and size < CHUNK_CHARS:
                text, parts, a = texts[at], [], 0
                for m in self.split.finditer(text) if self.split and any(s in text for s in self.special) else ():
                    # up to its last character a special string is ordinary text, with it one token
                    parts.append((*self._looked_up(text[a : m.end() - 1], missing), m.start() - a))
                    a = m.end()
                parts.append((*self._looked_up(text[a:], missing), -1))
                cut.append(parts)
                at, size = at + 1, size + len(text)
            if missing:
                self._learn(list(missing))
            for parts in cut:
                out, base = [np.zeros(1, np.int32)], 0
                for keys, found, special_at in parts:
                    own = self._joined(found if keys is None else list(map(self.known.new.__getitem__, keys)), base)
                    out.append(own)
                    if special_at >= 0:
                        base = (int(own[special_at - 1]) if special_at else base) + 1
                        out.append(np.array([base], np.int32))
                yield np.concatenate(out)

    def _looked_up(self, text: str, missing: dict[str, None]) -> tuple[list[str] | None, list[bytes | None]]:
        """What is known of a text's keys; the keys as well if some are new, which go to ``missing``."""
        keys, known, old = self._keys(text), self.known.new, self.known.old.get
        found = list(map(known.get, keys))
        if None not in found:
            return None, found
        for k in [k for k, v in enumerate(found) if v is None]:
            key = keys[k]
            if (v := old(key)) is None:
                missing[key] = None
            else:
                known[key] = v
        return keys, found

    def _joined(self, found: list[bytes], base: int) -> np.ndarray:
        flat = np.frombuffer(b"".join(found), "<i4")
        if not len(flat):
            return flat
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        total = flat[np.cumsum(size) - 1]
        return flat + np.repeat((np.cumsum(total) - total + base).astype(np.int32), size)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """The vocabulary of a file, read once in each worker."""
    return PrefixCounter(path)


def prefix_counts(df: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, counts array<int>): the tokens of the first 0, 1, ... characters, up to the whole text.

    Counts of prefixes may fall as well as rise, as more letters can make one token of
    several. A null text counts as empty and has the one count 0. Rows are taken one by
    one, so repeated keys stay repeated and null keys stay null; other columns are left
    out. An empty table gives an empty one. ``count_of``, ``tokens_upto`` and
    ``longest_within`` read the counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, at = [], 0
            for k, own in enumerate(counter(vocabulary).counts(batch.column(1).to_pylist()), 1):
                done.append(own)
                if k == batch.num_rows or sum(map(len, done)) > 2_000_000:
                    ends = np.cumsum([0, *map(len, done)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(done), pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, k - at), lists], names=["key", "counts"])
                    done, at = [], k

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), f"key {kind}, counts array<int>").withColumnRenamed("key", key)


def count_of(counts: str | Column = "counts") -> Column:
    """The tokens of the whole text."""
    return F.element_at(counts, -1).cast("long")


def tokens_upto(n_chars: int | Column, counts: str | Column = "counts") -> Column:
    """The tokens of the first ``n_chars`` characters, of the whole text where it is shorter."""
    n = F.lit(n_chars) if isinstance(n_chars, int) else n_chars
    counts = F.col(counts) if isinstance(counts, str) else counts
    return F.element_at(counts, F.least(F.greatest(n, F.lit(0)) + 1, F.size(counts)).cast("int")).cast("long")


def longest_within(budget: int | Column, counts: str | Column = "counts") -> Column:
    """How many characters the longest prefix of at most ``budget`` tokens has."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    counts = F.col(counts) if isinstance(counts, str) else counts
    return (F.size(counts) - F.array_position(F.transform(F.reverse(counts), lambda n: n <= limit), True)).cast("long")


def count_tokens(df: DataFrame, vocabulary: str, budgets: tuple[int, ...] = (), text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, fits): what each text has, and the longest prefix within each budget, in characters.

    The same as reading ``prefix_counts``, without storing the counts. A null text counts as
    empty. Rows are taken one by one; null and repeated keys stay. Other columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n_tokens, fits = [], []
            for own in counter(vocabulary).counts(texts):
                n_tokens.append(int(own[-1]))
                fits.append([len(own) - 1 if n_tokens[-1] <= b else len(own) - 1 - int(np.argmax(own[::-1] <= b)) for b in budgets])
            n_bytes = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n_tokens, pa.int64()), pa.array(fits, pa.list_(pa.int64()))], names=["key", "n_bytes", "n_tokens", "fits"])

    if any(b < 0 for b in budgets):
        raise ValueError("a budget is at least 0")
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), f"key {kind}, n_bytes long, n_tokens long, fits array<long>").withColumnRenamed("key", key)
