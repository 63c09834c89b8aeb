"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one pass of dynamic programming.

At each position the automaton's state and its output links name all pieces that end there, longest first; each relaxes
the best segmentation of the text up to that position. For a unigram model a segmentation's score is the sum of its
pieces' scores. For a merge (BPE) model the best one is what the merges make: a piece may follow another only if the
merges of both together give back these two, and exactly one piece passes at every reachable position.

All new stretches of a slice of texts take this pass in step: arrays hold the states of all of them at one position.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm.tables import documents, id_and_text, query
from corpuslens.llm.words import slices, text_buffers

SPACE = "▁"
CACHE_ENTRIES = 400_000
#: Pairs of pieces whose order is known, by a hash of the pair; a new pair takes the place of another.
PAIR_BITS = 21
#: Longer stretches are segmented by themselves and not remembered.
LONG_STRETCH = 64
#: No piece has a space mark behind another character, so no piece reaches from one stretch into the next.
_STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
UNIGRAM, MERGES = 1, 2


class Pieces:
    """The automaton and the scores of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        self.kind = model.trainer_spec.model_type
        self.prefix = model.normalizer_spec.add_dummy_prefix
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is can be decoded exactly")
        self.text = [p.piece for p in model.pieces]
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self._bytes = [x.encode() for x in self.text]
        for b, i in self.byte.items():
            self._bytes[i] = bytes([b])
        self._automaton()
        self._arrays()
        self._known: dict[str, bytes] = {}

    def _automaton(self) -> None:
        self.go: list[dict[str, int]] = [{}]
        self.ends: list[str] = [""]
        for piece in self.id:
            state = 0
            for c in piece:
                if c not in self.go[state]:
                    self.go[state][c] = len(self.go)
                    self.go.append({})
                    self.ends.append("")
                state = self.go[state][c]
            self.ends[state] = piece
        self.fail, self.output = [0] * len(self.go), [0] * len(self.go)
        todo = deque(self.go[0].values())
        while todo:
            state = todo.popleft()
            for c, child in self.go[state].items():
                back = self.fail[state]
                while back and c not in self.go[back]:
                    back = self.fail[back]
                self.fail[child] = self.go[back].get(c, 0) if state or self.go[back].get(c) != child else 0
                link = self.fail[child]
                self.output[child] = link if self.ends[link] else self.output[link]
                todo.append(child)

    def _arrays(self) -> None:
        """The automaton as sorted edges, and numbers for all that may stand before a piece: pieces, the beginning,
        a character that no piece holds, and each character that some piece holds."""
        letters = sorted({c for piece in self.id for c in piece})
        self._code = np.zeros(0x110000, np.int64)
        self._code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._width = len(letters) + 1
        self._start, self._none = len(self.text), -1
        self._lone = self._start + 1
        self._before = [*self.text, "", "\uffff", *letters]
        self._lonely = np.array([True, *(c not in self.id for c in letters)])
        self._size = np.array([*map(len, self.text), 0, *[1] * self._width])
        edges = sorted((s * self._width + int(self._code[ord(c)]), t) for s, go in enumerate(self.go) for c, t in go.items())
        self._edges = np.array([*(e for e, _ in edges), np.iinfo(np.int64).max])
        self._targets = np.array([*(t for _, t in edges), 0])
        self._fail = np.array(self.fail)
        self._piece = np.array([self.id.get(x, -1) for x in self.ends])
        self._next = np.array(self.output)
        self._scores = np.zeros(len(self.text))
        self._scores[list(self.id.values())] = list(self.score.values())
        self._pair = np.full(1 << PAIR_BITS, -1, np.int64)
        self._pair_follows = np.zeros(1 << PAIR_BITS, bool)

    def _moved(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states behind one more character each; fail links are followed until it fits."""
        state, out, todo = state.copy(), np.zeros_like(state), np.flatnonzero(code)
        while len(todo):
            key = state[todo] * self._width + code[todo]
            at = np.searchsorted(self._edges, key)
            hit = self._edges[at] == key
            out[todo[hit]] = self._targets[at[hit]]
            todo = todo[~hit & (state[todo] > 0)]
            state[todo] = self._fail[state[todo]]
        return out

    def _pairs_follow(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        key = last.astype(np.int64) * len(self.text) + piece
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        out = self._pair_follows[slot]
        miss = np.flatnonzero(self._pair[slot] != key)
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            fits = np.array([self._may_follow(self._before[k // len(self.text)], self.text[k % len(self.text)]) for k in new.tolist()])
            out[miss] = fits[back]
            self._pair[slot[miss]], self._pair_follows[slot[miss]] = key[miss], out[miss]
        return out

    def _segment_all(self, stretches: list[str]) -> list[bytes]:
        """The ids of each stretch as 32-bit integers; all stretches are passed through in step, longest first."""
        order = sorted(range(len(stretches)), key=lambda k: -len(stretches[k]))
        sizes = np.array([len(stretches[k]) for k in order], np.int64)
        points = np.frombuffer("".join(stretches[k] for k in order).encode("utf-32-le"), np.uint32)
        origin = np.cumsum(sizes) - sizes  # of the characters
        first = origin + np.arange(len(order))  # of the positions between characters, one more for each stretch
        code = self._code[points]
        best = np.full(len(points) + len(order), self._none, np.int64)
        score = np.full(len(best), -np.inf)
        best[first], score[first] = self._start, 0.0
        state = np.zeros(len(order), np.int64)
        for i in range(int(sizes.max(initial=0))):
            active = int(np.searchsorted(-sizes, -i, "left"))  # those with more than i characters
            letter = code[origin[:active] + i]
            state = self._moved(state[:active], letter)
            here = first[:active] + i + 1
            at = np.where(self._piece[state] >= 0, state, self._next[state])
            row = np.flatnonzero(at)
            while len(row):
                piece = self._piece[at[row]]
                there = here[row] - self._size[piece]
                open_ = best[there] != self._none
                if self.kind == MERGES:
                    open_ &= best[here[row]] == self._none
                    k = np.flatnonzero(open_)
                    k = k[self._pairs_follow(best[there[k]], piece[k])]
                    best[here[row[k]]] = piece[k]
                else:
                    total = score[there] + self._scores[piece]
                    k = np.flatnonzero(open_ & (total > score[here[row]]))
                    best[here[row[k]]], score[here[row[k]]] = piece[k], total[k]
                at[row] = self._next[at[row]]
                row = row[at[row] > 0]
            lone = score[here - 1] - 1e6
            k = np.flatnonzero(self._lonely[letter] & (best[here - 1] != self._none) & (
                (best[here] == self._none) | ((lone > score[here]) if self.kind != MERGES else False)))
            best[here[k]] = self._lone + letter[k]
            if self.kind != MERGES:
                score[here[k]] = lone[k]
        end = np.zeros(len(best), bool)
        at, floor = first + sizes, first
        while len(at):
            inside = at > floor
            at, floor = at[inside], floor[inside]
            end[at] = True
            at = at - self._size[best[at]]
        taken = np.flatnonzero(end)
        ids, begin = best[taken], np.searchsorted(taken, first, "right")
        raw = ids.astype("<i4").tobytes()
        cut = np.append(begin, len(ids))
        alone = np.flatnonzero(ids >= self._lone)
        out = [b""] * len(order)
        for k, a, b in zip(order, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            out[k] = raw[4 * a : 4 * b]
        for n in np.unique(np.searchsorted(begin, alone, "right") - 1).tolist():
            ends = (taken[cut[n] : cut[n + 1]] - first[n]).tolist()
            stretch = stretches[order[n]]
            out[order[n]] = self._ids([stretch[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        return out

    def _ids(self, pieces: list[str]) -> bytes:
        found = [i for x in pieces for i in ([self.id[x]] if x in self.id else [self.byte[b] for b in x.encode()])]
        return np.array(found, "<i4").tobytes()

    def _may_follow(self, last: str, piece: str) -> bool:
        """Whether the merges of both together, best score first and leftmost of equal ones, never join them."""
        parts, border, score = list(last + piece), len(last), self.score.get
        pairs = [score(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (top := max(pairs)) > -np.inf:
            k = pairs.index(top)
            if k == border - 1:
                return False
            border -= k < border
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = score(parts[k - 1] + parts[k], -np.inf)
            if k < len(pairs):
                pairs[k] = score(parts[k] + parts[k + 1], -np.inf)
        return len(parts) == (2 if last else 1)

    def segment(self, text: str) -> list[str]:
        """The best pieces of a stretch; a character that no piece covers stands alone."""
        best: list[tuple[float, str] | None] = [(0.0, "")] + [None] * len(text)
        follows = lru_cache(CACHE_ENTRIES)(self._may_follow)
        state = 0
        for i, c in enumerate(text, 1):
            while state and c not in self.go[state]:
                state = self.fail[state]
            state = self.go[state].get(c, 0)
            at = state if self.ends[state] else self.output[state]
            while at:
                piece = self.ends[at]
                before = best[i - len(piece)]
                if before is not None:
                    score = before[0] + self.score[piece]
                    if self.kind == MERGES:
                        if best[i] is None and follows(before[1], piece):
                            best[i] = (0.0, piece)
                    elif best[i] is None or score > best[i][0]:
                        best[i] = (score, piece)
                at = self.output[at]
            if c not in self.id and best[i - 1] is not None:
                lone = best[i - 1][0] - 1e6
                if best[i] is None or (self.kind != MERGES and lone > best[i][0]):
                    best[i] = (0.0 if self.kind == MERGES else lone, c)
        out, i = [], len(text)
        while i:
            out.append(best[i][1])
            i -= len(out[-1])
        return out[::-1]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers. New stretches are segmented together; of those known, the oldest
        half is forgotten when there are too many."""
        if len(self._known) > CACHE_ENTRIES:
            for s in list(islice(self._known, len(self._known) // 2)):
                del self._known[s]
        head = SPACE if self.prefix else ""
        split = [_STRETCH.findall(head + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = list({s for part in split for s in part} - self._known.keys())
        long = {s: self._ids(self.segment(s)) for s in new if len(s) > LONG_STRETCH}
        new = [s for s in new if len(s) <= LONG_STRETCH]
        self._known.update(zip(new, self._segment_all(new), strict=True))
        known = self._known
        if long:
            return [b"".join(long[s] if s in long else known[s] for s in part) for part in split]
        return [b"".join(map(known.__getitem__, part)) for part in split]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[str, Pieces] = {}


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int) and decoded, the text that the ids give back.

    Whole texts are encoded. NULL and empty texts have no ids and decode to the empty text; a text that holds the
    space mark itself comes back with spaces. NULL ids and repeated rows stay; other columns are ignored; an empty
    table gives an empty table. Rows are worked on where they are.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _MODELS.get(model) or _MODELS.setdefault(model, Pieces(model))
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for i, j in slices(text_buffers(texts)[1]):
                raw = pieces.encode_all(texts.slice(i, j - i).to_pylist())
                ends = np.cumsum([0, *map(len, raw)]) // 4
                flat = np.frombuffer(b"".join(raw), "<i4")
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                decoded = [pieces.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), ids, pa.array(decoded, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    part = id_and_text(docs)
    return part.mapInArrow(encode, f"doc_id {part.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
