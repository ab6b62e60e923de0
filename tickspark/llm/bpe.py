"""BPE encoding and decoding by speculation and verification.

A greedy longest match proposes tokens for each distinct word. The proposal is what
the merges would give exactly when every adjacent pair of it is stable: no merge could
ever have crossed the border between the two. Pairs are checked for a whole batch of
words at once with numpy; only words with an unstable pair are merged exactly, again
all at once: in every round each of them takes its next merge.

Words come from the vocabulary's own pre-tokenizer. Texts of ASCII and Latin letters are
cut by one regular expression that says the same; others are cut before each space that
starts a word, where a word always ends, and the library cuts those parts that hold
anything else. Words are looked up, so only new ones are encoded. The vocabulary file is
a parameter and must be a byte-level BPE file of the tokenizers library.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a worker keeps (some 200 bytes each) before the older half goes.
CACHE_ENTRIES = 600_000
#: Characters of text that are encoded together.
CHUNK_CHARS = 1_000_000
FAR = np.int64(1 << 40)
#: Letters of the Latin blocks in any version of Unicode, ASCII white space, and the cut of a
#: byte-level pre-tokenizer for texts that hold only those and other ASCII characters.
LATIN, SPACE = "A-Za-zÀ-ÖØ-öø-ɏ", r"\t\n\x0b\x0c\r "
WORD = re.compile(rf" ?[{LATIN}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^{SPACE}0-9{LATIN}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: A character that ``WORD`` is not meant for.
ODD = re.compile(rf"[^\x00-\x7F{LATIN}]")
#: Words up to so many bytes are encoded together with others; longer ones by themselves.
SHORT = 64
NEVER = 1 << 60


class Lookup:
    """A hash table from non-negative integers to non-negative integers that takes whole arrays; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            at, first = np.unique(slot[free], return_index=True)
            put = left[free[first]]
            self.keys[at], self.values[at] = keys[put], values[put]
            rest = self.keys[slot] != keys[left]
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


class Recent:
    """What was looked up lately. When the newer of two dictionaries is full, the older one goes."""

    def __init__(self, entries: int):
        self.limit, self.new, self.old = max(1, entries // 2), {}, {}

    def turn(self) -> None:
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairs:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers.pre_tokenizers import ByteLevel

        spec = json.loads(open(path, encoding="utf-8").read())
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True) or spec["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE file without a prefix space")
        self.pre = ByteLevel(add_prefix_space=False)
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*self.vocab.values(), *special.values()]) + 1
        self.born = np.full(self.size, -1, np.int64)  # rank of the merge that makes a token
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        self.ranks: dict[int, int] = {}  # pair -> its merge's rank, and in the lower 24 bits what it makes
        for rank, (a, b) in enumerate(merges):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.ranks[x * self.size + y] = rank << 24 | z
            if self.born[z] < 0:
                self.born[z], self.left[z], self.right[z] = rank, x, y
        self.pairs = Lookup(np.array(list(self.ranks), np.int64), np.array(list(self.ranks.values()), np.int64))
        stable = self._reachable()
        self.words = {t: i for t, i in self.vocab.items() if stable[i]}
        self.reach: dict[str, int] = {}  # by its first four letters, how long a token can be
        for t in self.words:
            self.reach[t[:4]] = max(self.reach.get(t[:4], 0), len(t))
        self.special = special
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        letters = byte_letters()
        self.bytes = [b""] * self.size
        for t, i in self.vocab.items():
            self.bytes[i] = bytes(letters[c] for c in t)
        for t, i in special.items():
            self.bytes[i] = t.encode()
        self.letters = {b: c for c, b in letters.items()}
        self.of_letter = letters
        self.letter_ids = np.array([self.vocab[self.letters[b]] for b in range(256)], np.int64)
        self.trie, self.token_at = self._prefixes()
        self.known = Recent(cache_entries)

    def _prefixes(self) -> tuple[Lookup, np.ndarray]:
        """A tree of the tokens' bytes: (node * 256 + byte) to the next node, and the token that each node ends, or -1."""
        nodes: dict[int, int] = {}
        ends = {}
        for t in self.words.values():
            at = 0
            for b in self.bytes[t]:
                at = nodes.setdefault(at * 256 + b, len(nodes) + 1)
            ends[at] = t
        token_at = np.full(len(nodes) + 1, -1, np.int64)
        token_at[list(ends)] = list(ends.values())
        return Lookup(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int64)), token_at

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the border of tokens a and b (before a rank, where given).

        Both tokens are undone step by step, the younger first. Each step shows the two
        symbols that once stood at the border; a merge of them crosses it if it comes
        before the merge that took the left one away, and not after that of the right one.
        """
        x, y, ok = a.copy(), b.copy(), np.ones(len(a), bool)
        end_x = np.full(len(a), FAR) if before is None else before.copy()
        end_y = np.full(len(a), FAR)
        live = np.arange(len(a))
        while len(live):
            found = self.pairs.get(x[live] * self.size + y[live])
            rank = np.where(found >= 0, found >> 24, FAR)
            crossed = (rank < end_x[live]) & (rank <= end_y[live]) & (rank < FAR)
            ok[live[crossed]] = False
            live = live[~crossed]
            bx, by = self.born[x[live]], self.born[y[live]]
            going = (bx >= 0) | (by >= 0)
            live, bx, by = live[going], bx[going], by[going]
            undo_x = bx > by
            ix, iy = live[undo_x], live[~undo_x]
            end_x[ix], x[ix] = bx[undo_x], self.right[x[ix]]
            end_y[iy], y[iy] = by[~undo_x], self.left[y[iy]]
        return ok

    def _reachable(self) -> np.ndarray:
        """Tokens whose own text the merges turn into just that token."""
        made = np.flatnonzero(self.born >= 0)
        ok = np.ones(self.size, bool)
        ok[made] = self.compatible(self.left[made], self.right[made], self.born[made])
        for t in made[np.argsort(self.born[made])]:
            ok[t] &= ok[self.left[t]] & ok[self.right[t]]
        return ok

    def greedy(self, word: str) -> list[int]:
        words = self.words
        if (t := words.get(word)) is not None:
            return [t]
        out, at, n, reach = [], 0, len(word), self.reach
        while at < n:
            end = at + (reach.get(word[at : at + 4]) or 3)
            while (t := words.get(word[at:end])) is None:
                end -= 1
            out.append(t)
            at = min(end, n)
        return out

    def merged(self, word: str) -> list[int]:
        """The merges in order of rank, the leftmost first."""
        ids, size, get = [self.vocab[c] for c in word], self.size, self.ranks.get
        if len(ids) > SHORT:
            return self._merged_long(ids)
        due, a = [], ids[0]
        for b in ids[1:]:
            due.append(get(a * size + b, NEVER))
            a = b
        due.append(NEVER)
        while (m := min(due)) != NEVER:
            k = due.index(m)
            made = ids[k] = m & 0xFFFFFF
            del ids[k + 1], due[k]
            if k:
                due[k - 1] = get(ids[k - 1] * size + made, NEVER)
            if k + 1 < len(ids):
                due[k] = get(made * size + ids[k + 1], NEVER)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same over a linked list and a heap."""
        n, size, ranks = len(ids), self.size, self.ranks
        after, back = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, ids[k], ids[k + 1]) for k in range(n - 1) if (r := ranks.get(ids[k] * size + ids[k + 1]))]
        heapq.heapify(heap)
        while heap:
            r, k, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            made = r & 0xFFFFFF
            ids[k], ids[j] = made, -1
            after[k] = after[j]
            if after[k] < n:
                back[after[k]] = k
                if r := ranks.get(made * size + ids[after[k]]):
                    heapq.heappush(heap, (r, k, made, ids[after[k]]))
            if back[k] >= 0 and (r := ranks.get(ids[back[k]] * size + made)):
                heapq.heappush(heap, (r, back[k], ids[back[k]], made))
        return [i for i in ids if i >= 0]

    def greedy_all(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest matches of many words at once: where each starts in ``raw``, and its token.

        ``ends`` are the borders of the words, one more than words.
        """
        at, stop = ends[:-1].copy(), ends[1:]
        pos, node, best, best_end = at.copy(), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at.copy()
        live, starts, tokens = np.flatnonzero(at < stop), [], []
        while len(live):
            p = pos[live]
            child = self.trie.get(node[live] * 256 + raw[np.minimum(p, len(raw) - 1)])
            on = (child >= 0) & (p < stop[live])
            go, child = live[on], child[on]
            node[go] = child
            pos[go] += 1
            token = self.token_at[child]
            ended = go[token >= 0]
            best[ended], best_end[ended] = token[token >= 0], pos[ended]
            done = live[~on]
            starts.append(at[done])
            tokens.append(best[done])
            at[done] = pos[done] = best_end[done]
            node[done] = 0
            live = live[at[live] < stop[live]]
        starts, tokens = np.concatenate(starts or [at[:0]]), np.concatenate(tokens or [at[:0]])
        order = np.argsort(starts)
        return starts[order], tokens[order]

    def merged_all(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact merges of many words at once, in the form of ``greedy_all``.

        In each round every word takes the merge of its lowest rank, the leftmost of them.
        """
        ids, start = self.letter_ids[raw], np.arange(len(raw))
        word = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        due = np.full(len(ids), NEVER)
        inner = np.flatnonzero(word[1:] == word[:-1])
        due[inner] = self._due(ids[inner], ids[inner + 1])
        starts, tokens = [], []
        while len(ids):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(due, first)
            each = np.repeat(least, np.diff(np.r_[first, len(ids)]))
            over = each == NEVER
            starts.append(start[over])
            tokens.append(ids[over])
            k = np.flatnonzero((due == each) & ~over)
            k = k[np.r_[True, word[k[1:]] != word[k[:-1]]]] if len(k) else k
            ids[k] = due[k] & 0xFFFFFF
            keep = ~over
            keep[k + 1] = False
            place = np.cumsum(keep) - 1
            ids, start, word, due, k = ids[keep], start[keep], word[keep], due[keep], place[k]
            due[k] = NEVER
            left = k[(k > 0) & (word[k - 1] == word[k])] - 1
            k = k[k + 1 < len(ids)]
            again = np.concatenate([left, k[word[k + 1] == word[k]]])
            due[again] = self._due(ids[again], ids[again + 1])
        starts, tokens = np.concatenate(starts or [start]), np.concatenate(tokens or [ids])
        order = np.argsort(starts)
        return starts[order], tokens[order]

    def _due(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found = self.pairs.get(a * self.size + b)
        return np.where(found >= 0, found, NEVER)

    def _fails(self, tokens: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The owners of which some adjacent pair of tokens isn't stable."""
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        if not len(inner):
            return owner[:0]
        keys, at = np.unique(tokens[inner] * self.size + tokens[inner + 1], return_inverse=True)
        return np.unique(owner[inner[~self.compatible(keys // self.size, keys % self.size)[at]]])

    def packed_words(self, words: list[bytes]) -> list[bytes]:
        """Speculate with the longest match, verify all adjacent pairs, merge what fails; ids as uint32."""
        out: list[bytes] = [b""] * len(words)
        long = [k for k, w in enumerate(words) if len(w) > SHORT]
        if long:
            own = ["".join(map(self.letters.__getitem__, words[k])) for k in long]
            found = [self.greedy(w) for w in own]
            owner = np.repeat(np.arange(len(long)), [len(f) for f in found])
            failed = set(self._fails(np.fromiter(chain.from_iterable(found), np.int64, len(owner)), owner).tolist())
            for n, k in enumerate(long):
                out[k] = array("I", self.merged(own[n]) if n in failed else found[n]).tobytes()
        short = [k for k, w in enumerate(words) if len(w) <= SHORT] if long else range(len(words))
        if not len(short):
            return out
        words = [words[k] for k in short] if long else words
        raw, size = np.frombuffer(b"".join(words), np.uint8), np.array([*map(len, words)])
        ends = np.r_[0, np.cumsum(size)]
        starts, tokens = self.greedy_all(raw, ends)
        owner = np.searchsorted(ends, starts, "right") - 1
        failed = self._fails(tokens, owner)
        if len(failed):
            bad = np.zeros(len(size), bool)
            bad[failed] = True
            inside = np.flatnonzero(np.repeat(bad, size))
            some, merged = self.merged_all(raw[inside], np.r_[0, np.cumsum(size[bad])])
            fine = ~bad[owner]
            starts, tokens = np.concatenate([starts[fine], inside[some]]), np.concatenate([tokens[fine], merged])
            order = np.argsort(starts, kind="stable")
            starts, tokens = starts[order], tokens[order]
        packed, cuts = tokens.astype("<u4").tobytes(), (4 * np.searchsorted(starts, ends)).tolist()
        for k, a, b in zip(short, cuts, cuts[1:]):
            out[k] = packed[a:b]
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The token ids of words that are given in the letters of the vocabulary."""
        raw = [bytes(map(self.of_letter.__getitem__, w)) for w in words]
        return [np.frombuffer(x, "<u4").tolist() for x in self.packed_words(raw)]

    def words_of(self, text: str) -> list[str]:
        """The text cut into words."""
        if text.isascii() or not ODD.search(text):
            return WORD.findall(text)
        out = []
        for part in re.split(r"(?= \S)", text):  # a space before anything but white space starts a word
            if not ODD.search(part):
                out += WORD.findall(part)
            else:
                out += [part[a:b] for _, (a, b) in self.pre.pre_tokenize_str(part)]
        return out

    def _look_up(self, words: list[str]) -> tuple[list[bytes | None], list[int]]:
        """What is known of the words, and the places of those that aren't."""
        known, old = self.known.new, self.known.old.get
        found = list(map(known.get, words))
        new = []
        if None in found:
            for k in [k for k, v in enumerate(found) if v is None]:
                w = words[k]
                if (v := old(w)) is None:
                    new.append(k)
                else:
                    found[k] = known[w] = v
        return found, new

    def _looked_up(self, text: str) -> tuple[list[bytes | None], list[tuple[int, str]]]:
        """The ids of each word of a text as far as they are known, and the place and the word of those that aren't."""
        if not (self.split and any(s in text for s in self.special)):
            words = self.words_of(text)
            found, new = self._look_up(words)
            return found, [(k, words[k]) for k in new]
        found, missing = [], []
        for part in filter(None, self.split.split(text)):
            if part in self.special:
                found.append(array("I", [self.special[part]]).tobytes())
                continue
            words = self.words_of(part)
            own, new = self._look_up(words)
            missing += [(len(found) + k, words[k]) for k in new]
            found += own
        return found, missing

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The token ids of each text."""
        done: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            self.known.turn()
            cut, size = [], 0
            missing: dict[str, None] = {}
            while at < len(texts) and size < CHUNK_CHARS:
                cut.append(self._looked_up(texts[at]))
                missing.update(dict.fromkeys([w for _, w in cut[-1][1]]))
                at, size = at + 1, size + len(texts[at])
            known = self.known.new
            if missing:
                known.update(zip(missing, self.packed_words([w.encode() for w in missing])))
            for found, new in cut:
                for k, w in new:
                    found[k] = known[w]
                done.append(np.frombuffer(b"".join(found), "<u4"))
        return done

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str, cache_entries: int = CACHE_ENTRIES) -> BytePairs:
    """The vocabulary of a file, read once in each worker."""
    return BytePairs(path, cache_entries)


def encode_documents(df: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>): the token ids of every text.

    A null text counts as empty; an empty text has no ids. Rows are taken one by one, so
    repeated keys stay repeated and null keys stay null. Other columns are left out, so
    their names can't clash. An empty table gives an empty one.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary)
        for batch in batches:
            ids = bpe.encode(batch.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)])
            at = 0
            while at < len(ids):  # at most some millions of ids in an Arrow batch
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + 4_000_000)) - 1)
                flat = np.concatenate(ids[at:to]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array((ends[at : to + 1] - ends[at]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), lists], names=["key", "ids"])
                at = to

    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode_documents(df: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The other columns of ``df``, and the text of each list of ids in ``into``.

    Null and empty lists give an empty text. A column that already has the name ``into``
    is replaced.
    """
    kept = [c for c in df.columns if c not in (ids, into)]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            texts = pa.array([bpe.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*kept, into])

    lists = F.coalesce(F.col(ids), F.array().cast("array<int>")).alias(ids)
    return df.select(*kept, lists).mapInArrow(run, f"{kinds + ', ' if kept else ''}`{into}` string")
