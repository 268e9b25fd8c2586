"""Subword encoding and decoding with a merge vocabulary that has byte fallback.

Method: the distinct words of a batch lie as symbols in one flat numpy array. Every round finds the lowest
pair rank of each word, merges all its leftmost non-overlapping occurrences in all words at once, and
compacts the array; words without a known pair leave it. A word is a run of space marks with what follows
up to the next one: no vocabulary entry has a space mark behind another character, so no merge crosses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kerbcast.llm.common import slices, texts_of

SPACE = "▁"
#: Symbols at and above this number stand for characters outside the vocabulary.
OUTSIDE = 1 << 17
NONE = np.iinfo(np.int32).max
#: Words remembered by one Python worker; the memory is emptied when full, which changes no result.
REMEMBERED = 300_000
NORMAL, BYTE = 1, 6


class PieceModel:
    """Vocabulary, merge table and word memory of one model file (BPE, byte fallback, no normalisation)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or spec.precompiled_charsmap
                or spec.remove_extra_whitespaces or not spec.add_dummy_prefix):
            raise ValueError("expected a BPE model with byte fallback, dummy prefix and no normalisation")
        self.text = [p.piece for p in proto.pieces]
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_value = {i: b for b, i in self.byte.items()}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has a space mark behind another character")
        score = [p.score for p in proto.pieces]
        order = {s: r for r, s in enumerate(sorted({score[i] for i in self.id.values()}, reverse=True))}
        self._merges(score, order)
        self.code = [b"%d," % i for i in range(len(self.text))]
        self.spaced = [p.replace(SPACE, " ") for p in self.text]
        self.single = np.arange(0x110000, dtype=np.int64) + OUTSIDE
        for p, i in self.id.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        #: Where no entry contains a line feed, it ends a word as well; that only helps the memory.
        mark = "" if any("\n" in p for p in self.id) else "\n"
        self.words = re.compile(f"{SPACE}+[^{SPACE}{mark}]*|[^{SPACE}{mark}]+" + (f"|{mark}" if mark else ""))
        self.known: dict[str, tuple[bytes, str]] = {}

    def _symbol(self, s: str) -> int | None:
        return self.id[s] if s in self.id else (OUTSIDE + ord(s) if len(s) == 1 else None)

    def _merges(self, score, order) -> None:
        pairs = {}
        alone = np.zeros(len(self.text), dtype=bool)
        for piece, i in self.id.items():
            for at in range(1, len(piece)):
                left, right = self._symbol(piece[:at]), self._symbol(piece[at:])
                if left is not None and right is not None:
                    pairs[(left << 21) | right] = (order[score[i]], i)
                    for part in (left, right):
                        # A merge that yields ``part`` can open a merge that goes first: one at a time then.
                        if part < OUTSIDE and score[i] >= score[part]:
                            alone[part] = True
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.keys = keys
        self.ranks = np.array([pairs[k][0] for k in keys.tolist()], dtype=np.int32)
        self.made = np.array([pairs[k][1] for k in keys.tolist()], dtype=np.int64)
        shared = np.bincount(self.ranks[np.unique(self.made, return_index=True)[1]], minlength=len(order))
        self.alone = alone | (shared[[order.get(s, 0) for s in score]] > 1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (left << 21) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.made[at], -1)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word (space marks written as such), found by merge rounds over all words."""
        code_points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        symbol = self.single[code_points]
        length = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), length)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self._pairs(symbol, word)
        while len(symbol):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(word)])
            least = np.repeat(np.minimum.reduceat(rank, start), size)
            # Words that are done leave the array.
            done = least == NONE
            if done.any():
                finished.append((symbol[done], word[done]))
                symbol, word, rank, made, least = (x[~done] for x in (symbol, word, rank, made, least))
                if not len(symbol):
                    break
                start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                size = np.diff(np.r_[start, len(word)])
            best = rank == least
            # Leftmost, non-overlapping: every second one of a run of neighbours; the first only where needed.
            place = np.arange(len(best))
            opens = best & ~np.r_[False, best[:-1]]
            begin = np.maximum.accumulate(np.where(opens, place, 0))
            chosen = best & ((place - begin) % 2 == 0)
            one = chosen & self.alone[np.maximum(made, 0)]
            if one.any():
                nth = np.cumsum(chosen)
                before = np.repeat(nth[start] - chosen[start], size)
                chosen &= ~(one & (nth - before > 1))
            at = np.flatnonzero(chosen)
            symbol[at] = made[at]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            touched = np.zeros(len(symbol), dtype=bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            # The left neighbour of a merged symbol may itself have been swallowed: step over it.
            gone = at[(at > 1) & ~keep[np.maximum(at - 1, 0)]]
            touched[gone - 2] = True
            symbol, word, rank, made, touched = (x[keep] for x in (symbol, word, rank, made, touched))
            redo = np.flatnonzero(touched)
            follows = redo + 1 < len(word)
            same = np.zeros(len(redo), dtype=bool)
            same[follows] = word[redo[follows]] == word[redo[follows] + 1]
            rank[redo], made[redo] = NONE, -1
            redo = redo[same]
            rank[redo], made[redo] = self._rank(symbol[redo], symbol[redo + 1])
        return self._by_word(finished, len(words))

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank = np.full(len(symbol), NONE, dtype=np.int32)
        made = np.full(len(symbol), -1, dtype=np.int64)
        if len(symbol) > 1:
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside], made[inside] = self._rank(symbol[inside], symbol[inside + 1])
        return rank, made

    def _by_word(self, finished: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[list[int]]:
        """The symbols of each word in order; a character outside the vocabulary becomes its bytes."""
        if not finished:
            return [[] for _ in range(n)]
        symbol, word = (np.concatenate(x) for x in zip(*finished))
        order = np.argsort(word, kind="stable")
        symbol = symbol[order]
        end = np.cumsum(np.bincount(word, minlength=n)).tolist()
        strange = np.zeros(n, dtype=bool)
        strange[word[order][symbol >= OUTSIDE]] = True
        symbols, start, out = symbol.tolist(), 0, []
        for stop, odd in zip(end, strange.tolist()):
            ids = symbols[start:stop]
            if odd:
                ids = [i for s in ids for i in (
                    (s,) if s < OUTSIDE else [self.byte[b] for b in chr(s - OUTSIDE).encode("utf-8")])]
            out.append(ids)
            start = stop
        return out

    def plain(self, ids: list[int]) -> str:
        """The text of ids of whole words: pieces as written, bytes decoded together, marks as spaces."""
        if self.byte_value.keys().isdisjoint(ids):
            return "".join([self.spaced[i] for i in ids])
        parts, run = [], bytearray()
        for i in ids:
            if i in self.byte_value:
                run.append(self.byte_value[i])
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
            parts.append(self.spaced[i])
        parts.append(run.decode("utf-8", "replace"))
        return "".join(parts)

    def learn(self, words: set[str]) -> None:
        """Put the words not yet remembered into the memory."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for w, ids in zip(new, self.encode_words(new)):
            self.known[w] = (b"".join([self.code[i] for i in ids]), self.plain(ids))

    def split(self, text: str) -> list[str]:
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_words(self.split(text)) for i in ids]

    def decode(self, ids: list[int]) -> str:
        return self.plain(ids)[1:]


_LOADED: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """One model per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def encoded(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """Ids and decoded text of every whole text.

    ``docs``: ``doc_id``, ``text``; other columns are ignored. Result, one row per input row, repeated rows
    included: ``doc_id``, ``n_tokens``, ``ids`` (array, left out unless ``with_ids``), ``ids_sha256`` over the
    decimal ids joined by commas, ``decoded``, ``decoded_sha256``. A null or empty text has no ids and decodes
    to the empty text. A null ``doc_id`` stays null. An empty table gives an empty result.
    """
    ids = "ids array<int>, decoded string, " if with_ids else ""
    schema = f"doc_id long, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(model_path)
        for batch in slices(batches):
            split = [model.split(t) for t in batch.column("text").to_pylist()]
            model.learn({w for x in split for w in x})
            n, all_ids, all_texts, sha, text_sha = [], [], [], [], []
            for words in split:
                known = [model.known[w] for w in words]
                joined = b"".join([k[0] for k in known])[:-1]
                decoded = "".join([k[1] for k in known])[1:]
                n.append(joined.count(b",") + 1 if joined else 0)
                sha.append(hashlib.sha256(joined).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if with_ids:
                    all_ids.append([int(x) for x in joined.split(b",")] if joined else [])
                    all_texts.append(decoded)
            middle = [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_texts, pa.string())] if with_ids else []
            names = ["doc_id", "n_tokens", *(["ids", "decoded"] if with_ids else []), "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), *middle, pa.array(sha, pa.string()),
                 pa.array(text_sha, pa.string())], names)

    return texts_of(docs).mapInArrow(run, schema)
