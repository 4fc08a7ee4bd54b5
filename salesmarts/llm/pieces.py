"""SentencePiece encoding and decoding by weighted finite-state transducers.

The model file is compiled into four machines. The normaliser maps a text to the symbols of the
pieces (a space before it, spaces as U+2581). The lexicon is a trie of all pieces whose arcs read
symbols and write a piece with its weight. Symbols outside the lexicon pass through the byte
fallback, which writes the pieces of their UTF-8 bytes. Over the pieces written stands an
acceptor of neighbours. For a unigram model it takes every pair, and a piece weighs its negative
score. For a model of merges it takes a pair only if merging the two pieces' joint text gives
back just them; the merges of a text are the one path all whose neighbours pass, and every
other path weighs infinity. Encoding composes these machines with the input and takes the
shortest path in the tropical semiring (least sum of weights); many inputs advance together, one
symbol at a time. Decoding runs the transducer backwards.

Runs of spaces are the exception that the merges' own order makes: their pieces share the lowest
score of all, so they form last and from the left. A last machine, which reads a run's length,
writes them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmarts.llm import common

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_UNIGRAM, _MERGES = 1, 2
#: Symbols that inputs advance together may hold in all; longer inputs go by themselves.
BATCH_SYMBOLS = 1 << 16
#: Words, and parts of words, whose pieces are kept for later texts.
MEMO_WORDS = 700_000


# The model file


def _fields(data: bytes):
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    kind: int
    dummy_prefix: bool
    squeeze: bool  # strip spaces around and squeeze runs
    fallback: bool

    @classmethod
    def read(cls, data: bytes) -> Model:
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                pieces.append((piece[1].decode(), score, piece.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        if normalizer.get(2) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models with the identity normaliser and spaces as prefixes are compiled")
        return cls(
            pieces, trainer.get(3, _UNIGRAM), bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1)), bool(trainer.get(35, 0))
        )


# The machines


@dataclass
class Lexicon:
    """A trie as sorted arc keys (state and symbol) with their targets, and the piece of a state."""

    keys: np.ndarray
    targets: np.ndarray
    piece: np.ndarray  # -1: no piece ends here
    longest: int

    @classmethod
    def compile(cls, texts: list[tuple[int, str]]) -> Lexicon:
        arcs: dict[tuple[int, int], int] = {}
        ends = {0: -1}
        for piece, text in texts:
            state = 0
            for symbol in map(ord, text):
                state = arcs.setdefault((state, symbol), len(arcs) + 1)
                ends.setdefault(state, -1)
            ends[state] = piece
        order = sorted(arcs)
        return cls(
            np.array([(s << 21) | c for s, c in order], np.int64),
            np.array([arcs[a] for a in order], np.int64),
            np.array([ends[s] for s in range(len(ends))], np.int64),
            max((len(t) for _, t in texts), default=0),
        )

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more symbol; -1 where there is no arc."""
        wanted = (states << 21) | symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.targets[at], -1)


@dataclass
class Neighbours:
    """Which two pieces may follow one another in a model of merges.

    ``left`` and ``right`` are the pieces whose merge makes a piece (itself for single symbols);
    ``merged`` the order of merging of the piece two pieces make, by their key.
    """

    left: np.ndarray
    right: np.ndarray
    order: np.ndarray
    keys: np.ndarray
    merged: np.ndarray
    known: dict = field(default_factory=dict)

    @classmethod
    def compile(cls, pieces: dict[str, int], order: np.ndarray, size: int) -> Neighbours:
        left, right = np.arange(size), np.arange(size)
        pairs: dict[int, int] = {}
        for text, piece in pieces.items():
            for cut in range(1, len(text)):
                a, b = pieces.get(text[:cut]), pieces.get(text[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = int(order[piece])
        for text, piece in pieces.items():
            if len(text) > 1:
                parts = _by_merging(text, pieces, order)
                if parts is not None:
                    left[piece], right[piece] = parts
        keys = np.array(sorted(pairs), np.int64)
        return cls(left, right, order, keys, np.array([pairs[k] for k in keys.tolist()], np.int64))

    def pass_(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the joint text of a and b never crosses the border between them.

        Both are taken apart along the border, the piece merged last first; a merge across it
        that comes before the one just undone would have been made instead.
        """
        a, b = a.copy(), b.copy()
        # The next merge undone on either side; a crossing merge must come after it.
        limit = np.full(len(a), np.iinfo(np.int64).max)
        leftmost = np.zeros(len(a), bool)  # whether an equally early crossing merge would win
        ok = np.ones(len(a), bool)
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo], b[todo]
            at = np.minimum(np.searchsorted(self.keys, x * len(self.left) + y), max(0, len(self.keys) - 1))
            crosses = self.keys[at] == x * len(self.left) + y if len(self.keys) else np.zeros(len(todo), bool)
            across = np.where(crosses, self.merged[at] if len(self.keys) else 0, np.iinfo(np.int64).max)
            bad = crosses & ((across < limit[todo]) | (leftmost[todo] & (across == limit[todo])))
            ok[todo[bad]] = False
            whole_x, whole_y = self.right[x] == x, self.left[y] == y
            undo_x = ~whole_x & (whole_y | (self.order[x] > self.order[y]))
            undo_y = ~whole_y & ~undo_x
            limit[todo] = np.where(undo_x, self.order[x], self.order[y])
            # Merges of the right piece lie right of the border: an equal one across it goes first.
            leftmost[todo] = undo_y
            a[todo] = np.where(undo_x, self.right[x], x)
            b[todo] = np.where(undo_y, self.left[y], y)
            todo = todo[~bad & (undo_x | undo_y)]
        return ok


def _by_merging(text: str, pieces: dict[str, int], order: np.ndarray) -> tuple[int, int] | None:
    """The last two parts when a piece's own text is merged; None if it never becomes the piece."""
    parts = list(text)
    while len(parts) > 2:
        best = min(
            ((order[pieces[parts[i] + parts[i + 1]]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in pieces),
            default=None,
        )
        if best is None:
            return None
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    if parts[0] not in pieces or parts[1] not in pieces:
        return None
    return pieces[parts[0]], pieces[parts[1]]


class Transducer:
    """A compiled model; ``encode`` and ``decode`` take and give many texts."""

    def __init__(self, data: bytes):
        model = self.model = Model.read(data)
        texts = [p for p, _, _ in model.pieces]
        self.unknown = next(i for i, p in enumerate(model.pieces) if p[2] == _UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == _BYTE}
        ordinary = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (_NORMAL, _USER, _UNUSED)}
        scores = np.array([s for _, s, _ in model.pieces])
        self.merges = model.kind == _MERGES
        if any(kind in (_USER, _UNUSED) for _, _, kind in model.pieces) or model.kind not in (_UNIGRAM, _MERGES):
            raise ValueError("user-defined and unused pieces, word and character models are not compiled")
        self.runs: dict[int, int] = {}
        if self.merges:
            self.runs = {len(p): i for p, i in ordinary.items() if set(p) == {SPACE} and len(p) > 1}
            ordinary = {p: i for p, i in ordinary.items() if i not in self.runs.values()}
            merged = [scores[i] for p, i in ordinary.items() if len(p) > 1]
            if self.runs and max(scores[i] for i in self.runs.values()) >= min(merged, default=0):
                raise ValueError("runs of spaces must merge last")
            rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
            self.neighbours = Neighbours.compile(ordinary, rank, len(texts))
        self.weights = np.zeros(len(texts)) if self.merges else -scores
        self.fallback_weight = 10 - min(scores[list(ordinary.values())], default=0.0)
        self.lexicon = Lexicon.compile(sorted((i, p) for p, i in ordinary.items()))
        self.space = ordinary.get(SPACE, -1)
        borders = {(ord(a), ord(b)) for p in ordinary for a, b in zip(p[:-1], p[1:], strict=True)}
        self.inside = np.array(sorted((a << 21) | b for a, b in borders), np.int64)
        self.cut_at_space = not any(SPACE in p[1:] for p in ordinary)
        self.run_pieces = [self._run(n) for n in range(1 + max(self.runs, default=1))]
        self.surface = [
            bytes([int(p[3:5], 16)]) if kind == _BYTE else b"" if kind == _CONTROL else " ⁇ ".encode() if kind == _UNKNOWN
            else p.replace(SPACE, " ").encode()
            for p, _, kind in model.pieces
        ]
        self.memo: dict[str, bytes] = {}  # a space-free word to the pieces of it with a space before
        self.chunks: dict[str, bytes] = {}  # parts of such words

    def _run(self, n: int) -> list[int]:
        """The pieces of a run of n spaces, whose merges all are equal and so go from the left."""
        sizes = [1] * n
        while True:
            at = next((i for i in range(len(sizes) - 1) if sizes[i] + sizes[i + 1] in self.runs), None)
            if at is None:
                return [self.space if k == 1 else self.runs[k] for k in sizes]
            sizes[at : at + 2] = [sizes[at] + sizes[at + 1]]

    # Composition and shortest path

    def paths(self, inputs: list[str]) -> list[list[int]]:
        """The pieces on the shortest path of each input, the byte fallback's included."""
        out: list[list[int]] = [[] for _ in inputs]
        order = sorted(range(len(inputs)), key=lambda i: len(inputs[i]))
        start = 0
        while start < len(order):
            stop = start
            while stop < len(order) and (stop == start or (stop - start + 1) * len(inputs[order[stop]]) <= BATCH_SYMBOLS):
                stop += 1
            for i, path in zip(order[start:stop], self._batch([inputs[i] for i in order[start:stop]]), strict=True):
                out[i] = path
            start = stop
        return out

    def _batch(self, inputs: list[str]) -> list[list[int]]:
        width = max(map(len, inputs), default=0)
        if not width:
            return [[] for _ in inputs]
        sizes = np.array([len(x) for x in inputs])
        symbols = np.full((len(inputs), width), -1, np.int64)
        flat = np.frombuffer("".join(inputs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        symbols[np.arange(width)[None, :] < sizes[:, None]] = flat
        # All arcs of the composition: input, start, end, piece.
        who, begin = np.nonzero(symbols >= 0)
        state, at = np.zeros(len(who), np.int64), begin.copy()
        arcs = []
        for _ in range(self.lexicon.longest):
            state = self.lexicon.step(state, symbols[who, at])
            alive = state >= 0
            who, begin, at, state = who[alive], begin[alive], at[alive] + 1, state[alive]
            piece = self.lexicon.piece[state]
            ends = piece >= 0
            arcs.append(np.stack((who[ends], begin[ends], at[ends], piece[ends])))
            going = (at < width) & (at < sizes[who])
            who, begin, at, state = who[going], begin[going], at[going], state[going]
            if not len(who):
                break
        arc = np.concatenate(arcs, axis=1)
        arc = arc[:, np.argsort(arc[2], kind="stable")]
        edges = np.searchsorted(arc[2], np.arange(width + 2))
        single = np.zeros((len(inputs), width), bool)  # symbols that the lexicon knows
        one = arc[2] - arc[1] == 1
        single[arc[0][one], arc[1][one]] = True
        cost = np.full((len(inputs), width + 1), np.inf)
        last = np.full((len(inputs), width + 1), -1, np.int64)  # piece that ends here; -2: fallback
        back = np.zeros((len(inputs), width + 1), np.int64)
        cost[:, 0] = 0
        for end in range(1, width + 1):
            missing = np.flatnonzero((sizes >= end) & ~single[:, end - 1])
            cost[missing, end] = cost[missing, end - 1] + (0 if self.merges else self.fallback_weight)
            last[missing, end], back[missing, end] = -2, end - 1
            who, begin, _, piece = arc[:, edges[end] : edges[end + 1]]
            weight = cost[who, begin] + self.weights[piece]
            if self.merges:
                before = last[who, begin]
                checked = np.flatnonzero((before >= 0) & np.isfinite(weight))
                weight[checked[~self._pass(before[checked], piece[checked])]] = np.inf
            best = np.lexsort((-begin, weight, who))
            first = best[np.flatnonzero(np.diff(who[best], prepend=-1))]
            first = first[weight[first] < cost[who[first], end]]
            cost[who[first], end], last[who[first], end], back[who[first], end] = weight[first], piece[first], begin[first]
        out: list[list[int]] = []
        for i, text in enumerate(inputs):
            path, end = [], len(text)
            while end > 0:
                if last[i, end] == -2:
                    path += self._bytes(text[end - 1])[::-1]
                else:
                    path.append(int(last[i, end]))
                end = int(back[i, end])
            out.append(path[::-1])
        return out

    def _pass(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Neighbours.pass_`` with a direct-mapped store of pairs seen before."""
        store = self.neighbours.known
        if not store:
            store["keys"], store["values"] = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        keys = a * len(self.weights) + b
        at = (keys * np.int64(0x9E3779B97F4A7C1 & 0x7FFFFFFFFFFFFFF) >> np.int64(24)) & np.int64((1 << 20) - 1)
        out = store["values"][at]
        new = np.flatnonzero(store["keys"][at] != keys)
        if len(new):
            out[new] = self.neighbours.pass_(a[new], b[new])
            store["keys"][at[new]], store["values"][at[new]] = keys[new], out[new]
            again = new[store["keys"][at[new]] == keys[new]]
            store["values"][at[again]] = out[again]
        return out

    def _bytes(self, symbol: str) -> list[int]:
        if not self.model.fallback:
            return [self.unknown]
        return [self.bytes[b] for b in symbol.encode("utf-8", "surrogatepass")]

    # Texts

    def _learn(self, words: list[str]) -> None:
        """Pieces of words with a space before, cut where no piece spans two symbols."""
        spaced = [SPACE + w for w in words]
        flat = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pairs = (flat[:-1] << 21) | flat[1:]
        at = np.minimum(np.searchsorted(self.inside, pairs), len(self.inside) - 1)
        cut = self.inside[at] != pairs if len(self.inside) else np.ones(len(pairs), bool)
        ends = np.cumsum([len(w) for w in spaced])
        cut[ends[:-1] - 1] = True
        edges = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(flat)])).tolist()
        joined = "".join(spaced)
        chunks = [joined[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        paths = self.chunks
        if len(paths) > MEMO_WORDS:
            paths.clear()
        new = list(set(chunks) - paths.keys())
        paths.update(zip(new, (np.array(p, "<u4").tobytes() for p in self.paths(new)), strict=True))
        done = np.searchsorted(np.array(edges[1:]), ends) + 1
        first = 0
        for word, stop in zip(words, done.tolist(), strict=True):
            self.memo[word] = paths[chunks[first]] if stop == first + 1 else b"".join([paths[c] for c in chunks[first:stop]])
            first = stop

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The pieces of each text, as the library encodes it."""
        normal = [self._normal(t) for t in texts]
        if not self.cut_at_space:
            return [np.array(p, np.uint32) for p in self.paths(normal)]
        # A piece can hold a space only at its start: each is encoded with the word after it.
        words = [t.split(SPACE) for t in normal]
        known = self.memo
        self._learn(list(set().union(*(w[1:] for w in words)) - known.keys()) or [""])
        out = []
        for text, parts in zip(normal, words, strict=True):
            ids = np.frombuffer(b"".join(map(known.__getitem__, parts[1:])), np.uint32)
            if parts[0]:  # only without the space before a text
                ids = np.concatenate((np.array(self.paths([parts[0]])[0], np.uint32), ids))
            out.append(self._with_runs(ids) if self.runs and SPACE * 2 in text else ids)
        if len(known) > MEMO_WORDS:
            known.clear()
        return out

    def _normal(self, text: str) -> str:
        if self.model.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        return ((" " if self.model.dummy_prefix else "") + text).replace(" ", SPACE)

    def _with_runs(self, ids: np.ndarray) -> np.ndarray:
        """Adjacent single spaces as pieces of runs; the longest piece as often as it fits."""
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ids == self.space, [0]))))
        longest = len(self.run_pieces) - 1
        out, done = [], 0
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if stop - start > 1:
                whole, rest = divmod(stop - start, longest)
                out += [ids[done:start], np.array(self.run_pieces[longest] * whole + self.run_pieces[rest], np.uint32)]
                done = stop
        return np.concatenate([*out, ids[done:]])

    def decode(self, ids) -> str:
        """The text that the pieces stand for, bytes that are no UTF-8 replaced."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))
        text = text.decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_TRANSDUCERS: dict[int, Transducer] = {}


def encoded(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, pieces (array<int>), n_pieces, round_trip.

    Pieces are those of the whole text without begin or end, as the sentencepiece library gives
    them. round_trip says whether decoding gives back the text; it fails only for texts that hold
    U+2581 itself. A null or empty text has no pieces and decodes to an empty one. Repeated rows
    give equal rows; a null id stays null; other columns are not read.
    """
    with open(model_file, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    key = hash(model_file)

    def scored(block: pa.RecordBatch) -> list:
        if key not in _TRANSDUCERS:
            _TRANSDUCERS[key] = Transducer(model.value)
        t, texts = _TRANSDUCERS[key], common.strings(block.column(1))
        ids = t.encode(texts)
        sizes = [len(x) for x in ids]
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]).astype(np.int32)), pa.array(flat))
        return [block.column(0), lists, sizes, [t.decode(x) == text for x, text in zip(ids, texts, strict=True)]]

    return common.per_text(
        common.texts_of(docs, id_col, text_col), scored,
        "doc_id bigint, pieces array<int>, n_pieces bigint, round_trip boolean",
    )


def decoded(encodings: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of each row's ``pieces``; null pieces give an empty text."""
    with open(model_file, "rb") as f:
        model = encodings.sparkSession.sparkContext.broadcast(f.read())
    key = hash(model_file)

    def run(batches):
        for batch in batches:
            if key not in _TRANSDUCERS:
                _TRANSDUCERS[key] = Transducer(model.value)
            texts = [_TRANSDUCERS[key].decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return common.importable(encodings).select("doc_id", "pieces").mapInArrow(run, "doc_id bigint, text string")
