"""Operator 7, BPE encoding and decoding: tokenization automaton.

The merges are compiled, in order, into a deterministic automaton over tokens
that accepts exactly the right tokenizations. It starts as one state with an arc
to itself for every base symbol. The gadget of a merge ``u v -> w`` is added when
the state after ``u`` has an arc ``v``: all arcs ``u`` are led to a copy of that
state without its arc ``v`` (so ``u v`` is no longer accepted), and every state
with an arc ``u`` gets an arc ``w`` to where ``v`` led. All arcs of a token lead
to one state, so each merge adds at most one state; copies are stored as parent,
time of birth and removed arc, and ``w``'s arcs as "where ``u`` has one", which
keeps the tables at a few numbers per merge (bounded by the vocabulary, so they
may be broadcast).

The automaton reads tokens; to read bytes it is composed with the trie of the tokens'
bytes and made deterministic. A state of the byte automaton is the set of (last token,
trie node) pairs that the bytes so far allow. Since every prefix of a word has exactly
one accepted path, each byte completes exactly one token that has an arc, and the
transition table gives the next state and that token: one look per byte, no search and
nothing taken back. Rows of the table are computed when a state is first met and kept, up
to ``STATES``: as a word's states are met the sooner the commoner they are, a full table
stays, and the rest of a word that leaves it walks on over sets that are not kept. The path is read off backwards from the word's last byte; decoding
emits the labels of its arcs.

Texts are split as the tokenizer file says: added tokens first, then NFC, blanks
collapsed, lower case, and the file's pattern. Texts of characters below U+0250
(and common punctuation) are split here; others, where Unicode versions could
differ, by the file's own normalizer and pre-tokenizer.

Defined cases: null text counts as empty and gives no tokens; very long words are
encoded in linear time and not remembered (the table's states are); repeated rows give repeated rows; an
empty table gives no rows; extra columns are kept by ``with_tokens``.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.text import on_text, text_udf

#: Remembered words per Python worker, and the longest one remembered. An executor holds a
#: worker's tables once for each Python worker, idle ones included.
CACHE = 100_000
CACHED_CHARS = 48
#: Byte-automaton states a worker keeps, and the steps beside a full table, per state,
#: after which it starts again.
STATES = 50_000
MISSED = 20
_END = 1 << 62

#: Characters split by the rules below alone.
_PLAIN = regex.compile("[\t\n\x0c\r\x20-\x7e\xa0-ɏ‐-‧€]*")


def _byte_symbols() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairSets:
    """Sets of (last token, trie node) pairs by number, at 8 bytes a pair."""

    def __init__(self, bits: int):
        self.bits, self.mask = bits, (1 << bits) - 1
        self.packed: list[bytes] = []

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, state: int) -> list[tuple[int, int]]:
        return [(p >> self.bits, p & self.mask) for p in self.pairs(state)]

    def pairs(self, state: int) -> memoryview:
        """The pairs as packed numbers."""
        return memoryview(self.packed[state]).cast("q")


class Transitions:
    """(state, byte) -> (next state, completed token), both in one number."""

    def __init__(self, bits: int):
        self.bits, self.mask = bits, (1 << bits) - 1
        self.packed: dict[int, int] = {}

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, key: int) -> tuple[int, int]:
        found = self.packed[key]
        return found >> self.bits, found & self.mask


class Automaton:
    """Tables of the tokenization automaton of one tokenizer file. They are made on the
    driver, as flat arrays; a copy that was pickled has them, and nothing remembered."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        # The file's normalizer and pre-tokenizer, without its vocabulary.
        self.rules = json.dumps({"version": conf["version"], "added_tokens": [], "normalizer": conf["normalizer"],
                                 "pre_tokenizer": conf["pre_tokenizer"], "model": {"type": "BPE", "vocab": {}, "merges": []}})
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.added = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.added_split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pattern = next(p["pattern"]["Regex"] for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern)
        self.letters_whole = r"|[\p{L}]+|" in pattern
        self.size = size = 1 + max([*vocab.values(), *self.added.values()])
        self.labels = [b""] * size
        for token, i in [*vocab.items(), *self.added.items()]:
            self.labels[i] = token.encode()
        # Of each token: its parts, its time of birth (-1: base); of each removed arc
        # (the state after a token, the arc's token): the time at which it was lost.
        self.left, self.right, self.born = (array("i", [-1]) * size for _ in range(3))
        self.lost: dict[int, int] = {}
        self.states = 1
        for r, (a, b) in enumerate(merges):
            self._add_merge(vocab[a], vocab[b], vocab[a + b], 2 * r + 1)
        made = {vocab[a + b] for a, b in merges}
        byte = _byte_symbols()
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            if i in made and self.born[i] < 0:
                continue  # its merge never applies: no arc bears it
            end = bool(self.suffix) and token.endswith(self.suffix)
            body = token.removesuffix(self.suffix) if end else token
            if body and all(c in byte for c in body):
                raw = bytes(byte[c] for c in body)
                (self.final if end else self.inner)[raw] = i
        if not self.suffix:
            self.final = self.inner
        # Trie of the tokens' bytes, nodes by length and bytes: node n + 1 hangs on edge n, whose
        # byte is in ``edges``; a node's edges begin at ``first``. Then the tokens that end at a node.
        nodes = sorted({raw[:k] for raw in {*self.inner, *self.final} for k in range(len(raw) + 1)} | {b""}, key=lambda n: (len(n), n))
        number = {n: i for i, n in enumerate(nodes)}
        parents = np.array([number[n[:-1]] for n in nodes[1:]], np.int64)
        self.edges = bytes(n[-1] for n in nodes[1:])
        self.first = array("i", np.searchsorted(parents, np.arange(len(nodes) + 1)).tolist())
        self.inner_at, self.final_at = (array("i", [found.get(n, -1) for n in nodes]) for found in (self.inner, self.final))
        self.length = array("i", [0]) * size
        for raw, i in [*self.inner.items(), *self.final.items()]:
            self.length[i] = len(raw)
        self._forget()

    def __getstate__(self) -> dict:
        """What a worker needs: no word lists, no library object, nothing remembered."""
        left_out = ("inner", "final", "_lib", "cache", "old", "sets", "numbers", "table", "ends", "missed")
        return {k: v for k, v in self.__dict__.items() if k not in left_out}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self._lib = None
        # Words met of late, and those met before them.
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._restart()

    @property
    def lib(self):
        if self._lib is None:
            from tokenizers import Tokenizer

            self._lib = Tokenizer.from_str(self.rules)
        return self._lib

    def _add_merge(self, u: int, v: int, w: int, now: int) -> None:
        if not self._has_arc(u, now, v):
            return
        self.lost[u * self.size + v] = now
        self.states += 1
        self.left[w], self.right[w], self.born[w] = u, v, now + 1

    def _has_arc(self, prev: int, now: int, token: int) -> bool:
        """Has the state after ``prev``, as it was at time ``now``, an arc ``token``?"""
        born, lost, size = self.born, self.lost.get, self.size
        while True:
            if lost(prev * size + token, now + 1) <= now:
                return False
            p, t = born[prev], born[token]
            if p > t:  # an older arc: as the state after the right part had it before the merge
                prev, now = self.right[prev], p - 2
            elif t < 0:
                return True
            else:  # a younger arc: wherever its left part had one
                token, now = self.left[token], min(now, t)

    def follows(self, prev: int, token: int) -> bool:
        """Has the state after ``prev`` an arc ``token``?"""
        return self._has_arc(prev, _END, token)

    def _restart(self) -> None:
        """The byte automaton's start: no token yet, the trie's root."""
        self.sets = PairSets(len(self.edges).bit_length())
        self.numbers: dict[bytes, int] = {}
        self._number([-1 << self.sets.bits])
        # Of a state and byte: the next state and completed token, and the token at a word's last byte.
        self.table = Transitions(self.size.bit_length())
        self.ends: dict[int, int] = {}
        self.missed = 0

    def _number(self, pairs: list[int]) -> int | None:
        """The state of these pairs; none if it is not kept and the table is full."""
        key = array("q", pairs).tobytes()
        state = self.numbers.get(key)
        if state is None and len(self.sets) < STATES:
            state = self.numbers[key] = len(self.sets)
            self.sets.packed.append(key)
        return state

    def _completed(self, pairs, byte: int, tokens: array) -> tuple[list[int], int]:
        """The pairs one byte on, and the token it completes along an arc."""
        on, done, bits, mask = [], -1, self.sets.bits, self.sets.mask
        find, first = self.edges.find, self.first
        for pair in pairs:
            node = pair & mask
            to = find(byte, first[node], first[node + 1]) + 1
            if to:
                if first[to] < first[to + 1]:
                    on.append(pair - node + to)
                token = tokens[to]
                if token >= 0 and (pair < 0 or self.follows(pair >> bits, token)):
                    done = token
        if done < 0:
            raise ValueError("a byte without a token")
        return on, done

    def _add_transition(self, state: int, byte: int) -> int | None:
        on, done = self._completed(self.sets.pairs(state), byte, self.inner_at)
        on.append(done << self.sets.bits)
        on.sort()
        number = self._number(on)
        if number is None:
            return None
        to = number << self.table.bits | done
        if len(self.table) < 4 * STATES:
            self.table.packed[state << 8 | byte] = to
        return to

    def _add_end(self, state: int, byte: int) -> int:
        done = self._completed(self.sets.pairs(state), byte, self.final_at)[1]
        if len(self.ends) < 2 * STATES:
            self.ends[state << 8 | byte] = done
        return done

    def _walk(self, state: int, rest: bytes, steps: list[int]) -> int:
        """The rest of a word from a state of the full table on: its last token, the others in ``steps``."""
        self.missed += len(rest)
        pairs = self.sets.pairs(state)
        for byte in rest[:-1]:
            pairs, done = self._completed(pairs, byte, self.inner_at)
            pairs.append(done << self.sets.bits)
            steps.append(done)
        return self._completed(pairs, rest[-1], self.final_at)[1]

    def encode_word(self, word: bytes) -> list[int]:
        """The one accepted path over a pre-split word, one transition a byte."""
        if len(self.sets) > STATES or self.missed > MISSED * STATES:
            self._restart()
        if not word:
            return []
        step, state, steps = self.table.packed.get, 0, []
        bits, mask = self.table.bits, self.table.mask
        for byte in word[:-1]:
            to = step(state << 8 | byte)
            if to is None:
                to = self._add_transition(state, byte)
                if to is None:
                    token = self._walk(state, word[len(steps):], steps)
                    break
            state = to >> bits
            steps.append(to)
        else:
            token = self.ends.get(state << 8 | word[-1])
            if token is None:
                token = self._add_end(state, word[-1])
        # Back along the path: the token that ends at each place says where it began.
        path, length, pos = [token], self.length, len(word) - self.length[token]
        while pos:
            token = steps[pos - 1] & mask
            path.append(token)
            pos -= length[token]
        path.reverse()
        return path

    def _encode_chunk(self, chunk: str) -> bytes:
        """A chunk without blanks; remembered unless very long."""
        got = self.cache.get(chunk) or self.old.get(chunk)
        if got is None:
            words = [chunk] if self.letters_whole and chunk.isalpha() else self.pattern.findall(chunk)
            if len(words) == 1:
                got = np.array(self.encode_word(words[0].encode()), "<u4").tobytes()
            else:
                got = b"".join([self.cache.get(w) or self._encode_chunk(w) for w in words])
        if len(chunk) <= CACHED_CHARS:
            if len(self.cache) >= CACHE // 2:
                self.old, self.cache = self.cache, {}
            self.cache[chunk] = got
        return got

    def _encode_plain(self, text: str) -> bytes:
        cache, new = self.cache.get, self._encode_chunk
        return b"".join([cache(c) or new(c) for c in text.lower().split()])

    def _encode_other(self, text: str) -> bytes:
        byte = _byte_symbols()
        words = self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(text))
        ids = [i for w, _ in words for i in self.encode_word(bytes(byte[c] for c in w))]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        parts = self.added_split.split(text) if self.added_split else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                out.append(self._encode_plain(part) if _PLAIN.fullmatch(part) else self._encode_other(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs, joined as the file (which names no decoder) has it."""
        return b" ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_BUILT: dict[str, Automaton] = {}


def automaton(spec: str) -> Automaton:
    """The compiled automaton of a tokenizer file's text, once per process; it reaches the
    executors by broadcast (size fixed by the vocabulary, about 3 MB)."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _BUILT:
        _BUILT[key] = Automaton(spec)
    return _BUILT[key]


def read_spec(path: str) -> str:
    """A vocabulary file's text."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _digest_batch(shared):
    def batch(texts):
        a = shared.value
        rows = []
        for t in texts:
            ids = a.encode(t.decode("utf-8", "replace")) if t else b""
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(a.decode(ids)).hexdigest()))
        return rows
    return batch


def _token_batch(shared):
    def batch(texts):
        a = shared.value
        rows = []
        for t in texts:
            ids = a.encode(t.decode("utf-8", "replace")) if t else b""
            rows.append((np.frombuffer(ids, "<u4").astype(np.int32), a.decode(ids).decode("utf-8", "replace")))
        return rows
    return batch


def with_tokens(df: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """Every column of ``df`` plus ``tokens`` (array<int>) and ``decoded`` (string);
    columns of these names are replaced."""
    shared = df.sparkSession.sparkContext.broadcast(automaton(read_spec(path or default_path())))
    keep = [c for c in df.columns if c not in ("tokens", "decoded")]
    return on_text(df, text_udf("tokens array<int>, decoded string", _token_batch(shared)), keep, text_col)


def token_digest(df: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each text."""
    shared = df.sparkSession.sparkContext.broadcast(automaton(read_spec(path or default_path())))
    udf = text_udf("n_tokens long, ids_sha256 string, decoded_sha256 string", _digest_batch(shared))
    return on_text(df, udf, keep or ["doc_id"])
